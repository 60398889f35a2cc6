"""One row per key where deliveries repeat."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fullness(df: DataFrame, skip: Sequence[str] = ()) -> Column:
    """How many columns of a row hold something; empty strings count as nothing. skip: columns not worth reading for it."""
    one = [
        F.when((F.col(f"`{c}`") != "") if t == "string" else F.col(f"`{c}`").isNotNull(), 1).otherwise(0)
        for c, t in df.dtypes
        if c not in skip
    ]
    return sum(one[1:], one[0]) if one else F.lit(0)


def rank(df: DataFrame, columns: Sequence[str], skip: Sequence[str] = ("before_content", "after_content")) -> Column:
    """Of repeated deliveries the one that counts has the greatest: the fuller one, of equally full ones the greater hash."""
    return F.struct(fullness(df, skip).alias("f"), F.xxhash64(*columns).alias("h"))


def fuller(
    df: DataFrame, key: str, columns: Sequence[str], skip: Sequence[str] = ("before_content", "after_content"), facts: Mapping[str, Column] | None = None
) -> DataFrame:
    """One row (key, columns, facts) per non-null key: of repeated deliveries the fuller one, of equally full ones the greater hash.

    facts: expressions over all columns of df, worked out before deliveries are told apart; so what is asked of a text (its hash,
    its length) moves in the text's place. Deliveries with a null key are dropped, an empty table stays empty. The aggregation
    combines before the shuffle, and a hot key holds one row per map task at most.
    """
    facts = facts or {}
    row = F.struct(*columns, *[c.alias(n) for n, c in facts.items()])
    best = F.struct(fullness(df, skip).alias("f"), F.xxhash64(*columns, *facts.values()).alias("h"))
    rows = df.where(F.col(key).isNotNull()).select(key, row.alias("row"), best.alias("best"))
    one = rows.groupBy(key).agg(F.max_by("row", "best").alias("row"))
    return one.select(key, *[F.col("row").getField(c).alias(c) for c in (*columns, *facts)])


def once(df: DataFrame, key: str, columns: Sequence[str], skip: Sequence[str] = ()) -> DataFrame:
    """As fuller(), but rows move only if some key repeats: a first scan of the key column alone looks for repeats."""
    if df.where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1").isEmpty():
        return df.where(F.col(key).isNotNull()).select(key, *columns)
    return fuller(df, key, columns, skip)
