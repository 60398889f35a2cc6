"""Order-dependent operators over revision histories. Order is explicit: callers pass the columns that define it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.session import materialize


def instant(c: Column | str) -> Column:
    """ISO text with any offset as a timestamp, null if it is none."""
    return F.try_to_timestamp(F.col(c) if isinstance(c, str) else c)


def with_previous(df: DataFrame, chain: Sequence[str], order: Sequence[Column | str], value: str, name: str) -> DataFrame:
    """Adds the last non-null value before each row of its chain, and is_first: none came before."""
    w = Window.partitionBy(*chain).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = df.withColumn(name, F.last(value, ignorenulls=True).over(w))
    return out.withColumn("is_first", F.col(name).isNull())


def before_revert(df: DataFrame, chain: Sequence[str], order: Sequence[Column | str], subject: str) -> DataFrame:
    """Adds pre_revert: the next subject of the chain begins with "revert"."""
    nxt = F.lead(subject).over(Window.partitionBy(*chain).orderBy(*order))
    said = F.lower(F.regexp_replace(F.coalesce(nxt, F.lit("")), r"(?U)^\s+", ""))
    return df.withColumn("pre_revert", said.startswith("revert"))


def seen_before(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Adds a flag: an earlier row has the same keys. Rows with a null key are never flagged.

    The first row per key comes from an aggregation that combines before the shuffle, so a key that a third of all rows share is
    no window of its own; the join back may be split by AQE.
    """
    this = F.struct(*order)
    first = df.groupBy(*keys).agg(F.min(this).alias("__first"))
    out = df.join(first, list(keys), "left")
    return out.withColumn(name, F.coalesce(this > F.col("__first"), F.lit(False))).drop("__first")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row per key by order, as an aggregation."""
    rest = [c for c in df.columns if c not in keys]
    one = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__row"))
    return one.select(*keys, *[F.col("__row").getField(c).alias(c) for c in rest])


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row per key by order, as an aggregation: the current entry of a journal."""
    rest = [c for c in df.columns if c not in keys]
    one = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("__row"))
    return one.select(*keys, *[F.col("__row").getField(c).alias(c) for c in rest])


def first_n(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first n rows by order: work cut to a budget, the same rows on every run."""
    return df.orderBy(*order).limit(n)


def last_n(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The last n rows by order, the last first."""
    return df.orderBy(*[F.desc(c) for c in order]).limit(n)


def new_content(incoming: DataFrame, known: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Rows of incoming whose key is neither known nor met earlier in incoming."""
    fresh = incoming.join(known.select(key).distinct(), key, "left_anti")
    return first_per_key(fresh, [key], order)


def dense_ids(df: DataFrame, group: str, order: str, prefix: str, width: int = 7) -> DataFrame:
    """(group, id): prefix and a zero-padded number by first appearance. The groups are sorted over all tasks; each task's rows
    are numbered on from the sum of the tasks before it, a table of one row per task."""
    first = df.groupBy(group).agg(F.min(order).alias("__o"))
    # the id Spark gives holds the task in its upper bits and the place within it in the lower 33
    rows = materialize(first.orderBy("__o", group).select(group, F.monotonically_increasing_id().alias("m")))
    rows = rows.select(group, F.shiftright("m", 33).alias("task"), F.col("m").bitwiseAND(F.lit((1 << 33) - 1)).alias("place"))
    w = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    begin = rows.groupBy("task").count().select("task", F.coalesce(F.sum("count").over(w), F.lit(0)).alias("begin"))
    n = (F.col("begin") + F.col("place")).cast("string")
    # longer numbers than the width keep all their digits
    return rows.join(begin, "task").select(group, F.concat(F.lit(prefix), F.when(F.length(n) < width, F.lpad(n, width, "0")).otherwise(n)).alias("id"))
