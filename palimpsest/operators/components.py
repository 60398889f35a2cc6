"""Connected components of an edge table, by alternating star contractions; nothing but counters reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.session import materialize, release


def _stars(pairs: DataFrame) -> DataFrame:
    """pairs (u, v): every v of a u is tied to the smallest of them; a hot u is pre-aggregated and its pairs may be split by AQE."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return pairs.join(least, "u")


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 50) -> DataFrame:
    """(node, component) for every node of an edge; the component is its smallest node.

    Null ends and loops are dropped, repeated edges count once; an empty edge table gives an empty result. Rounds follow the
    logarithm of the longest path, not its length. Raises if max_rounds do not suffice, never returns unfinished components.
    """
    e = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where("a is not null and b is not null and a <> b")
    # u is the larger end
    now = materialize(e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = None
    for _ in range(max_rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _stars(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        small = _stars(large)
        out = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        out = out.unionByName(small.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        nxt = materialize(out)
        row = nxt.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        release(now)
        now = nxt
        if (row[0], row[1]) == state:
            break
        state = (row[0], row[1])
    else:
        raise RuntimeError(f"components not settled after {max_rounds} rounds")
    tied = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return tied.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
