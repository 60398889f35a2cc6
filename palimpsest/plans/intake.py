"""Intake: raw deliveries of revisions and of bundled files as records of the corpus, and a platform added to what is held."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.functions.tags import size_facts
from palimpsest.functions.text import stable_id, strip, text_of
from palimpsest.operators.chain import instant
from palimpsest.operators.dims import aligned_union, seed_of
from palimpsest.operators.records import fuller
from palimpsest.operators.subset import refuse_present
from palimpsest.plans.revisions import identity_facts, with_base_tags, with_intent
from palimpsest.session import materialize

#: What a raw delivery has, as the sources of histories give it.
RAW = (
    "repo", "skill_path", "skill_name", "before_sha", "after_sha", "before_content", "after_content", "commit_subject", "commit_author", "commit_email", "commit_date",
    "lines_added", "lines_removed", "char_delta", "is_initial",
)
RECORD = (
    "pair_id", "skill_id", "repo", "source_seed", "platform", "skill_path", "skill_name", "before_sha", "after_sha", "before_content", "after_content", "commit_subject",
    "commit_author", "commit_email", "commit_date", "lines_added", "lines_removed", "char_delta", "is_initial", "intent_class", "intent_confidence", "intent_source", "quality_tags",
)


def _given(df: DataFrame, c: str, kind: str) -> Column:
    """A column as its kind, null where df lacks it."""
    return (F.col(c) if c in df.columns else F.lit(None)).cast(kind)


def identified(raw: DataFrame, platform: str | Column, seeds: Sequence[tuple[str, DataFrame]] = ()) -> DataFrame:
    """raw (RAW; columns that are missing count as null) with ids, source and platform, and defaults: '' for missing texts, 0 for
    missing counts, false for a missing flag, blanks around the subject dropped. Rows without a repository, a path or a commit are no
    revisions and left out."""
    rows = raw.where("repo is not null and skill_path is not null and after_sha is not null")
    text = lambda c: text_of(_given(raw, c, "string"))
    count = lambda c: F.coalesce(_given(raw, c, "int"), F.lit(0))
    c = F.col
    out = rows.select(
        stable_id(c("repo"), c("skill_path"), _given(raw, "before_sha", "string"), c("after_sha")).alias("pair_id"), stable_id(c("repo"), c("skill_path")).alias("skill_id"), "repo",
        (F.lit(platform) if isinstance(platform, str) else platform).alias("platform"), "skill_path", text("skill_name").alias("skill_name"),
        _given(raw, "before_sha", "string").alias("before_sha"), "after_sha", _given(raw, "before_content", "string").alias("before_content"), text("after_content").alias("after_content"),
        strip(text("commit_subject")).alias("commit_subject"), *[text(x).alias(x) for x in ("commit_author", "commit_email", "commit_date")],
        *[count(x).alias(x) for x in ("lines_added", "lines_removed", "char_delta")], F.coalesce(_given(raw, "is_initial", "boolean"), F.lit(False)).alias("is_initial"),
    )
    return seed_of(out, "repo", seeds) if seeds else out.withColumn("source_seed", F.lit("other"))


def normalised(raw: DataFrame, platform: str | Column, seeds: Sequence[tuple[str, DataFrame]] = (), held: DataFrame | None = None) -> DataFrame:
    """Raw deliveries as records (RECORD): identified, with intent and base tags; of repeated deliveries the fuller counts.

    held: records that are there already; their texts count as seen before all new ones. Duplicates are told by hashes on narrow
    rows; texts are joined to the tags once, at the end."""
    rows = identified(raw, platform, seeds)
    narrow = [c for c in rows.columns if c not in ("pair_id", "before_content", "after_content")]
    facts = identity_facts() | size_facts()
    one = fuller(rows, "pair_id", narrow, facts=facts | {"h": F.xxhash64("before_content", "after_content")})
    one = materialize(one.withColumn("ts", instant("commit_date")))
    tagged = with_base_tags(with_intent(one))
    if held is not None:
        seen = lambda k, c: held.select(c.alias(k)).distinct().withColumn(f"__{k}", F.lit(True))
        tagged = tagged.join(seen("after_hash", identity_facts()["after_hash"]), "after_hash", "left").join(seen("pair_hash", identity_facts()["pair_hash"]), "pair_hash", "left")
        more = [F.when(F.col(f"__{k}"), F.array(F.lit(t))).otherwise(F.array().cast("array<string>")) for k, t in (("after_hash", "duplicate_after"), ("pair_hash", "duplicate_pair"))]
        tagged = tagged.withColumn("quality_tags", F.array_sort(F.array_union(F.array_union("quality_tags", more[0]), more[1])))
    tags = tagged.select("pair_id", "h", "intent_class", "intent_confidence", F.lit("regex").alias("intent_source"), "quality_tags")
    # equal deliveries have one hash, so one of them is taken
    texts = rows.withColumn("h", F.xxhash64("before_content", "after_content")).dropDuplicates(["pair_id", "h"])
    return texts.join(tags, ["pair_id", "h"]).select(*RECORD)


def add_platform(held: DataFrame, raw: DataFrame, platform: str, seeds: Sequence[tuple[str, DataFrame]] = ()) -> DataFrame:
    """held with the records of a platform that it does not have yet (an error if it has), under held's columns."""
    refuse_present(held, "platform", platform)
    return aligned_union(held, normalised(raw, platform, seeds, held))


_FILE = "struct<path:string,size:bigint,content:string,binary_or_oversize:boolean>"


def bundled(raw: DataFrame) -> DataFrame:
    """Raw bundles as records: ids, '' and 0 for what is missing, an empty list for no files, and for every file a path, a size and
    a flag."""
    c, empty = F.col, F.array().cast(f"array<{_FILE}>")
    text = lambda x: text_of(_given(raw, x, "string")).alias(x)
    count = lambda x: F.coalesce(_given(raw, x, "int"), F.lit(0)).alias(x)
    one = lambda f: F.struct(
        text_of(f["path"]).alias("path"), F.coalesce(f["size"].cast("bigint"), F.lit(0).cast("bigint")).alias("size"), f["content"].alias("content"),
        F.coalesce(f["binary_or_oversize"].cast("boolean"), F.lit(False)).alias("binary_or_oversize"),
    )
    files = F.coalesce(F.transform("bundled_files", one), empty) if "bundled_files" in raw.columns else empty
    return raw.where("repo is not null and skill_path is not null").select(
        stable_id(c("repo"), c("skill_path")).alias("skill_id"), "repo", "skill_path", text("skill_dir"), text("skill_name"), text("head_sha"),
        count("bundled_count"), count("bundled_text_count"), files.alias("bundled_files"),
    )
