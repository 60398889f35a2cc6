"""The consolidation plan: raw deliveries to classified, tagged, scored revisions, in pure steps over narrow rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.functions.intent import intent
from palimpsest.functions.tags import base_tags, content_tags, quality_score, repo_tags, size_facts
from palimpsest.functions.text import content_hash, pair_hash, text_of
from palimpsest.operators.chain import before_revert, instant, seen_before
from palimpsest.operators.records import fuller
from palimpsest.session import materialize, spread, table

CHAIN = ("repo", "skill_path")
ORDER = ("ts", "pair_id")
#: Today, for rules about age.
AS_OF = "2024-06-01"


def revisions(spark: SparkSession, d: str, columns: Sequence[str], facts: Mapping[str, Column] | None = None) -> DataFrame:
    """One row (pair_id, columns, facts) per pair_id, of the fuller delivery, with ts, the commit's instant, if commit_date is among
    the columns. facts are worked out where the texts are read, so that the texts need not move."""
    rows = table(spark, d, "diffs")
    rows = fuller(spread(rows) if facts else rows, "pair_id", columns, facts=facts)
    return rows.withColumn("ts", instant("commit_date")) if "commit_date" in columns else rows


def with_intent(df: DataFrame) -> DataFrame:
    """Replaces the intent columns by those of the rules."""
    cols = ("commit_subject", "is_initial", "lines_added", "lines_removed", "char_delta")
    i = intent(*[F.col(c) for c in cols])
    return df.withColumn("__i", i).withColumns({"intent_class": F.col("__i.class"), "intent_confidence": F.col("__i.confidence")}).drop("__i")


def family(platform: str = "platform") -> Column:
    """Editor rules and skills are told apart when duplicates are sought."""
    return F.when(F.col(platform) == "cursor_rule", "cursor").otherwise("skill")


TAG_COLUMNS = (
    "repo", "platform", "skill_path", "commit_subject", "commit_email", "commit_date", "lines_added", "lines_removed", "char_delta", "is_initial",
)


def identity_facts() -> dict[str, Column]:
    """Hashes of a revision's texts by which duplicates are sought; nobody's and empty texts have no author_hash."""
    after, before = F.col("after_content"), F.col("before_content")
    someone = (text_of("commit_email") != "") & (text_of("after_content") != "")
    return {
        "after_hash": content_hash(text_of("after_content")), "pair_hash": pair_hash(before, after),
        "author_hash": F.when(someone, F.sha1(F.concat("commit_email", F.lit("\x00"), after))),
    }


def tag_facts() -> dict[str, Column]:
    return identity_facts() | size_facts()


def with_base_tags(df: DataFrame) -> DataFrame:
    """Adds base tags; df has the TAG_COLUMNS, tag_facts, ts and an intent class, and no texts. Duplicates are flagged after their
    first appearance in the order of commits, per family."""
    rows = df.withColumn("family", family())
    rows = seen_before(rows, ["family", "after_hash"], ORDER, "duplicate_after")
    rows = seen_before(rows, ["family", "pair_hash"], ORDER, "duplicate_pair")
    rows = before_revert(rows, CHAIN, ORDER, "commit_subject")
    return rows.withColumn("quality_tags", base_tags(F.col("intent_class"), F.col("duplicate_after"), F.col("duplicate_pair"), F.col("pre_revert")))


def tagged(spark: SparkSession, d: str, columns: Sequence[str] = (), facts: Mapping[str, Column] | None = None) -> DataFrame:
    """Revisions with intent and base tags. The texts are read once: their facts are written as a narrow table first, as the
    search for duplicates reads it several times."""
    rows = revisions(spark, d, [*dict.fromkeys([*TAG_COLUMNS, *columns])], tag_facts() | dict(facts or {}))
    return with_base_tags(with_intent(materialize(rows)))


def same_author(df: DataFrame) -> DataFrame:
    """Adds same_author_dup: the same author delivered the same text (author_hash) before."""
    return seen_before(df, ["author_hash"], ORDER, "same_author_dup")


def repositories(spark: SparkSession, d: str) -> DataFrame:
    """One row per repository: of several platforms' rows the fullest, then the first platform."""
    return fuller(table(spark, d, "repos").withColumn("key", F.col("repo")), "key", ["repo", "license_spdx", "stars", "pushed_at", "fetch_status"]).drop("key")


def with_all_tags(df: DataFrame, repos: DataFrame, as_of: str = AS_OF) -> DataFrame:
    """Adds license_spdx, stars and every tag: base, content (content_tags), repository, same author."""
    known = repos.select("repo", "license_spdx", "stars", "pushed_at", F.lit(True).alias("known"))
    rows = same_author(df).join(known, "repo", "left")
    facts = repo_tags(F.col("known"), F.col("license_spdx"), F.col("stars"), F.col("pushed_at"), F.lit(as_of).cast("timestamp"))
    twice = F.when(F.col("same_author_dup"), F.array(F.lit("same_author_dup"))).otherwise(F.array().cast("array<string>"))
    tags = F.array_sort(F.array_union(F.array_union(F.array_union("quality_tags", "content_tags"), facts), twice))
    return rows.withColumn("quality_tags", tags)


def with_score(df: DataFrame) -> DataFrame:
    cols = ("quality_tags", "license_spdx", "stars", "pr_title", "intent_class", "after_length")
    return df.withColumn("quality_score", quality_score(*[F.col(c) for c in cols]))


def consolidated(spark: SparkSession, d: str, extra: Sequence[str] = ()) -> DataFrame:
    """All steps: one row per revision with recomputed intent, tags and score. No text is moved; whoever wants the texts of a
    result joins them by pair_id."""
    rows = tagged(spark, d, ["pr_title", "is_canonical", *extra], {"content_tags": content_tags(F.col("after_content"))})
    return with_score(with_all_tags(rows, repositories(spark, d)))
