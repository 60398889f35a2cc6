"""Problem 7: capping the records of dominant contributors.

Method: parallel bisection. Every contributor above the limit keeps bounds of its score cutoff; each round counts, for all of
them together, the records in every slice between the bounds, and the slice that holds the cutoff becomes the new bounds, until
it holds one score. Records on the cutoff itself are told apart by identifier: the same descent goes on over its characters.

No contributor's records ever meet in one task: a round joins the records with one row of bounds per contributor and counts
them with map-side combination. Bounds stay a table (at most N / limit rows), the driver sees only how many are unsettled.

Defined results: null and empty contributors are nobody and have no limit; null and NaN scores come last, infinite ones are the
greatest or least; ties go to the smaller identifier; repeated identifiers count once (the fuller delivery); an empty table drops nothing.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.operators.records import fuller
from palimpsest.session import materialize, release

SLICES = 256


def _descend(counts: DataFrame, order: list[Column]) -> DataFrame:
    """Of each contributor's slices (c records each) the one in which the room-th record lies; above: those before it."""
    w = Window.partitionBy("dim", "who").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    upto = counts.withColumn("upto", F.sum("c").over(w))
    return upto.where("upto >= room and upto - c < room")


def cutoffs(rows: DataFrame, max_rounds: int = 300) -> DataFrame:
    """rows (dim, who, score, id, room), of contributors above their limit only -> (dim, who, cut, prefix): kept are the
    records with a score above cut, or on it and with an identifier whose first characters are at most prefix. cut is null where
    the cutoff lies among the records without a score. Doubles span 2^2098, a round leaves 1 / SLICES of what is between the
    bounds, so 263 rounds settle any scores; infinite ones are told from others first."""
    known = rows.groupBy("dim", "who").agg(
        F.first("room").alias("limit"), F.count("score").alias("scored"), F.min("score").alias("lo"), F.max("score").alias("hi")
    )
    state = materialize(
        known.select(
            "dim", "who",
            F.when(F.col("limit") <= F.col("scored"), F.col("limit")).otherwise(F.col("limit") - F.col("scored")).alias("room"),
            *[F.when(F.col("limit") <= F.col("scored"), F.col(c)).alias(c) for c in ("lo", "hi")],
        )
    )
    rows = rows.select("dim", "who", "score", "id")
    for _ in range(max_rounds):
        if state.where("lo < hi").isEmpty():
            break
        # halves, as the difference of two doubles may be none
        hi, lo, score = (F.col(c) / 2 for c in ("hi", "lo", "score"))
        even = F.least(F.floor((hi - score) / (hi - lo) * SLICES), F.lit(SLICES - 1))
        endless = F.abs("hi") == float("inf"), F.abs("lo") == float("inf")
        by_kind = F.when(F.col("score") == float("inf"), 0).when(F.col("score") == float("-inf"), 2).otherwise(1)
        at = F.when(endless[0] | endless[1], by_kind).otherwise(even)
        inside = rows.join(state.where("lo < hi"), ["dim", "who"]).where("score >= lo and score <= hi")
        counts = inside.groupBy("dim", "who", "room", at.alias("slice")).agg(
            F.count("*").alias("c"), F.min("score").alias("lo"), F.max("score").alias("hi")
        )
        found = _descend(counts, [F.col("slice")]).select(
            "dim", "who", (F.col("room") - F.col("upto") + F.col("c")).alias("room"), "lo", "hi"
        )
        state, old = materialize(state.where("not coalesce(lo < hi, false)").unionByName(found)), state
        release(old)
    else:
        raise RuntimeError("cutoffs not settled")
    state = materialize(state.select("dim", "who", "room", F.col("lo").alias("cut"), F.lit("").alias("prefix"), F.lit(False).alias("done")))
    ties = rows.join(state.select("dim", "who", "cut"), ["dim", "who"]).where("score <=> cut").select("dim", "who", "id")
    ties = materialize(ties)
    for _ in range(max_rounds):
        if state.where("not done").isEmpty():
            break
        inside = ties.join(state.where("not done"), ["dim", "who"]).where("startswith(id, prefix)")
        counts = inside.groupBy(
            "dim", "who", "room", "cut", "prefix", F.expr("substring(id, length(prefix) + 1, 1)").alias("next")
        ).agg(F.count("*").alias("c"))
        found = _descend(counts, [F.col("next")]).select(
            "dim", "who", (F.col("room") - F.col("upto") + F.col("c")).alias("room"), "cut",
            F.concat("prefix", "next").alias("prefix"), (F.col("upto") == F.col("room")).alias("done"),
        )
        state, old = materialize(state.where("done").unionByName(found)), state
        release(old)
    else:
        raise RuntimeError("ties not settled")
    release(ties)
    return state.select("dim", "who", "cut", "prefix")


def cap(
    df: DataFrame, key: str, score: str, contributors: Mapping[str, Column], limit: int | None = None, share: float | None = None
) -> DataFrame:
    """(key, over): every record once, and whether it is beyond the limit of any of its contributors.

    contributors: dimension -> expression of the contributor. limit: records a contributor may keep; or share: that share of
    the distinct keys, rounded down. Contributors of unlike dimensions are limited separately.
    """
    if (limit is None) == (share is None):
        raise ValueError("give limit or share")
    named = df.select(*[c for c in df.columns])
    for i, who in enumerate(contributors.values()):
        named = named.withColumn(f"__who{i}", F.nullif(who, F.lit("")))
    named = named.withColumn("__score", F.expr(f"nullif(cast(`{score}` as double), double('NaN'))"))
    whos = [f"__who{i}" for i in range(len(contributors))]
    once = materialize(fuller(named, key, ["__score", *whos]).withColumnRenamed(key, "id"))
    if limit is None:
        limit = int(once.count() * share + 1e-9)
    dims = F.explode(F.array(*[F.struct(F.lit(i).alias("dim"), F.col(w).alias("who")) for i, w in enumerate(whos)]))
    long = once.select(F.col("__score").alias("score"), "id", dims.alias("d")).select("score", "id", "d.dim", "d.who")
    long = long.where("who is not null")
    heavy = long.groupBy("dim", "who").count().where(F.col("count") > limit).select("dim", "who")
    rows = materialize(long.join(heavy, ["dim", "who"]).withColumn("room", F.lit(limit).cast("bigint")))
    if limit == 0:
        over = rows.select("id").distinct()
    else:
        cuts = cutoffs(rows)
        before = F.expr("score > cut or (cut is null and score is not null)")
        on_it = F.expr("score <=> cut and substring(id, 1, length(prefix)) <= prefix")
        keep = F.coalesce(before, F.lit(False)) | on_it
        over = rows.join(cuts, ["dim", "who"]).where(~keep).select("id").distinct()
    return once.join(over.withColumn("over", F.lit(True)), "id", "left").select(
        F.col("id").alias(key), F.coalesce("over", F.lit(False)).alias("over")
    )
