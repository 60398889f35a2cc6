"""Subsets of revisions for training and evaluation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.functions.tags import NOT_CLEAN, NOT_CURATED, NOT_STRICT
from palimpsest.functions.text import strip, text_of

# Intents that are no edit to learn from, and commit subjects that say nothing.
NO_EDIT = ("whitespace", "merge", "micro")
GENERIC = ("wip", "update", "fix", "fixes", "edit", "stuff", "changes", "misc", "various", "minor", "tweak", "tweaks", ".", "..", "wip.")


def has_none(tags: Column, names: Sequence[str]) -> Column:
    return ~F.arrays_overlap(F.coalesce(tags, F.array().cast("array<string>")), F.array(*map(F.lit, names)))


def clean(df: DataFrame, include_initial: bool = False, names: Sequence[str] = NOT_CLEAN) -> DataFrame:
    """Edits without a disqualifying tag."""
    rows = df if include_initial else df.where(~F.coalesce("is_initial", F.lit(False)))
    return rows.where(has_none(F.col("quality_tags"), names))


def intent_text(title: Column, subject: Column) -> Column:
    """The pull request's title, or else the commit's subject."""
    return F.coalesce(F.nullif(strip(text_of(title)), F.lit("")), strip(text_of(subject)))


def curated(df: DataFrame, strict: bool = False) -> DataFrame:
    """Canonical edits without disqualifying tags, of a class to learn from, with an intent that says something."""
    names = (*NOT_CURATED, *NOT_STRICT) if strict else NOT_CURATED
    said = intent_text(F.col("pr_title"), F.col("commit_subject"))
    return (
        clean(df, names=names)
        .where(F.coalesce("is_canonical", F.lit(False)))
        .where(~F.coalesce(F.col("intent_class").isin(*NO_EDIT), F.lit(False)))
        .withColumn("intent_text", said)
        .where((F.length("intent_text") >= 8) & ~F.lower("intent_text").isin(*GENERIC))
    )


def evaluable(before: Column, after: Column, intent: Column) -> Column:
    """Whether an edit suits evaluation: both texts long enough, the intent clear, the change of size moderate."""
    b, a = F.length(text_of(before)), F.length(text_of(after))
    ratio = a.cast("double") / b
    return F.coalesce((b >= 200) & (a >= 200) & (a <= 30_000) & (F.length(text_of(intent)) >= 12) & ratio.between(0.3, 3.0), F.lit(False))


def stratified(df: DataFrame, key: str, stratum: str, n: int, seed: int) -> DataFrame:
    """n rows per stratum by the order of a seeded hash: the same rows on every run and layout.

    Hashes are even, so of N rows the n least lie below (n + 10 sqrt(n) + 20) / N but for one case in 10^20: the rows are cut there
    first, by a count per stratum, and a window sees that many of a stratum, however large it is."""
    h = F.sha1(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))
    rows = df.withColumn("__h", h)
    sizes = df.groupBy(F.col(stratum).alias("__s")).agg(F.count("*").alias("__size"))
    u = F.conv(F.substring("__h", 1, 13), 16, 10).cast("double") / float(1 << 52)
    some = rows.join(sizes, F.col(stratum).eqNullSafe(F.col("__s"))).where(u <= float(n + 10 * n**0.5 + 20) / F.col("__size")).drop("__s", "__size")
    return some.withColumn("__n", F.row_number().over(Window.partitionBy(stratum).orderBy("__h"))).where(f"__n <= {n}").drop("__h", "__n")


def present(df: DataFrame, required: Sequence[str], optional: Sequence[str] = ()) -> DataFrame:
    """The required columns and those of the optional ones that df has, in this order; a required one that is missing is an error."""
    lacking = [c for c in required if c not in df.columns]
    if lacking:
        raise ValueError(f"columns missing: {', '.join(lacking)}")
    return df.select(*[f"`{c}`" for c in (*required, *[c for c in optional if c in df.columns])])


def evaluable_first(before: Column, after: Column, intent: Column) -> Column:
    """The first edition of evaluable: both texts long enough, no massive rewrite, the intent clear, the text not cut down."""
    b, a = F.length(text_of(before)), F.length(text_of(after))
    return F.coalesce((b >= 200) & (a >= 200) & (F.abs(a - b) <= 20_000) & (F.length(text_of(intent)) >= 12) & (a >= 0.3 * b), F.lit(False))


def card(
    df: DataFrame, platform: str | None = None, with_pr: bool = False, most_change: int | None = None, intents: Sequence[str] = (),
    least_score: float | None = None, canonical: bool = False, edit_kinds: Sequence[str] = (),
) -> DataFrame:
    """The subsets a data card names: every condition given must hold; edit_kinds asks the nested diff_summary.edit_kind."""
    tests = [
        F.col("platform") == platform if platform else None,
        F.coalesce("pr_title", F.lit("")) != "" if with_pr else None,
        F.abs("char_delta") < most_change if most_change is not None else None,
        F.col("intent_class").isin(*intents) if intents else None,
        F.round(F.col("quality_score").cast("double"), 6) >= least_score if least_score is not None else None,
        F.coalesce("is_canonical", F.lit(False)) if canonical else None,
        F.col("diff_summary.edit_kind").isin(*edit_kinds) if edit_kinds else None,
    ]
    for t in tests:
        df = df if t is None else df.where(t)
    return df


def refuse_present(df: DataFrame, column: str, value: str) -> None:
    """An error if any row has the value: a platform is not added twice."""
    if not df.where(F.col(column) == value).isEmpty():
        raise ValueError(f"{column} {value!r} is there already")
