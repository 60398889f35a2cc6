"""Queries of the training-data problems, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from palimpsest.llm import bpe, capping, mixing, neardup, overlap, pii, reading, residue, secrets, splits
from palimpsest.operators.records import fuller, once, rank
from palimpsest.session import materialize, spread, table

Query = Callable[[SparkSession, str], DataFrame]

TIES = ("repo", "skill_id", "skill_cluster_id")


def _p1_texts(spark: SparkSession, d: str, single: bool = False) -> DataFrame:
    """Every text of a record; single: of the fuller delivery alone."""
    rows = table(spark, d, "diffs")
    rows = once(rows, "pair_id", ["pr_body", "after_content"], ("before_content", "after_content")) if single else rows.where("pair_id is not null")
    parts = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("text")) for c in ("pr_body", "after_content")]))
    return spread(rows.select("pair_id", "pr_body", "after_content")).select("pair_id", parts.alias("p")).select("pair_id", "p.field", "p.text").where("text is not null and text <> ''")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    # second deliveries hold the same texts or none, so the distinct rows are those of the fuller one
    return pii.scan(_p1_texts(spark, d), ["pair_id", "field"]).select("pair_id", "field", "kind", "line_no").distinct()


def p1_kinds(spark: SparkSession, d: str) -> DataFrame:
    """Items and records with any, per field and kind."""
    found = pii.scan(_p1_texts(spark, d), ["pair_id", "field"]).distinct()
    return found.groupBy("field", "kind").agg(F.count("*").alias("items"), F.countDistinct("pair_id").alias("records"))


def p1_redacted(spark: SparkSession, d: str) -> DataFrame:
    return pii.redacted(_p1_texts(spark, d, single=True), ["pair_id", "field"])


def _p2_files(spark: SparkSession, d: str, single: bool = False) -> DataFrame:
    """All texts that may hold credentials, of every delivery; single: of the fuller delivery alone."""
    bundled, diffs = table(spark, d, "bundled"), table(spark, d, "diffs")
    if single:
        bundled = once(bundled, "skill_id", ["bundled_files"], ["bundled_files"])
        diffs = once(diffs, "pair_id", ["after_content"], ("before_content", "after_content"))
    f = bundled.where("skill_id is not null").select("skill_id", F.explode("bundled_files").alias("f"))
    files = f.select(
        F.lit("bundled").alias("source_table"), F.col("skill_id").alias("record_id"), F.col("f.path").alias("file_path"),
        F.col("f.content").alias("content"), F.lit(True).alias("is_file"),
    )
    texts = diffs.where("pair_id is not null").select(
        F.lit("diffs").alias("source_table"), F.col("pair_id").alias("record_id"), F.lit("after_content").alias("file_path"),
        F.col("after_content").alias("content"), F.lit(False).alias("is_file"),
    )
    return spread(files).unionByName(spread(texts)).where("content is not null and content <> ''")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return secrets.scan(_p2_files(spark, d)).select("source_table", "record_id", "file_path", "line_no").distinct()


def p2_kinds(spark: SparkSession, d: str) -> DataFrame:
    """Findings per table and kind, and records that have any."""
    found = secrets.scan(_p2_files(spark, d)).distinct()
    return found.groupBy("source_table", "kind").agg(F.count("*").alias("findings"), F.countDistinct("record_id").alias("records"))


def p2_redacted(spark: SparkSession, d: str) -> DataFrame:
    return secrets.redacted(_p2_files(spark, d, single=True))


def _p3(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(pair_id, group_id, intent_class) and (pair_id, group_id, split)."""
    groups = materialize(splits.tie_groups(table(spark, d, "curator_training"), "pair_id", TIES, ["intent_class"]))
    return groups, splits.assign_splits(groups, "pair_id", "intent_class")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _p3(spark, d)[1].select("pair_id", "group_id")


def p3_splits(spark: SparkSession, d: str) -> DataFrame:
    return _p3(spark, d)[1]


def p3_report(spark: SparkSession, d: str) -> DataFrame:
    """Per split: records, share and target, and by how much its labels differ from those of all records."""
    groups, found = _p3(spark, d)
    return splits.balance(found.join(groups.select("pair_id", "intent_class"), "pair_id"), "intent_class")


def p3_balance(spark: SparkSession, d: str) -> DataFrame:
    """Whether every split's share is off by no more than 0.01 or the largest group, and its labels by no more than 0.1 and that."""
    off = F.col("label_deviation") <= 0.1 + F.col("largest_group")
    return p3_report(spark, d).select("split", "within", off.alias("labels_within"))


def _latest(spark: SparkSession, d: str) -> DataFrame:
    """(skill_id, text): the latest after_content of every skill, of equal instants the one with the greatest pair_id."""
    when = F.struct(F.expr("try_cast(commit_date AS timestamp)"), F.col("pair_id"), F.col("after_content").isNotNull())
    rows = table(spark, d, "diffs").where("skill_id is not null")
    return materialize(rows.groupBy("skill_id").agg(F.max_by("after_content", when).alias("text")))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    # similarity is defined on distinct runs, so every run weighs one
    members, pairs = neardup.similar_pairs(_latest(spark, d), "skill_id", 0.7, counts=False, least_words=60)
    return neardup.member_pairs(members, pairs, "skill_id")


def p4_groups(spark: SparkSession, d: str) -> DataFrame:
    members, pairs = neardup.similar_pairs(_latest(spark, d), "skill_id", 0.8)
    return neardup.groups(members, pairs, "skill_id")


def _p5(spark: SparkSession, d: str) -> DataFrame:
    ev, tr = table(spark, d, "curator_eval_set"), table(spark, d, "curator_training")
    sides = []
    for df, key, texts in ((ev, "key_e", ["before_content", "after_content"]), (tr, "key_t", ["after_content"])):
        ranked = df.where("pair_id is not null").select(F.col("pair_id").alias(key), rank(df, texts).alias("rank"), *texts)
        sides.append(ranked.select(key, "rank", F.explode(F.array(*texts)).alias("text")))
    return overlap.overlaps(*sides, 0.7)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    # containment is never less than similarity, so no pair of this similarity is lost
    return _p5(spark, d).where("similarity >= 0.7 - 1e-9").select(F.least("key_e", "key_t").alias("pair_id_a"), F.greatest("key_e", "key_t").alias("pair_id_b"))


def p5_report(spark: SparkSession, d: str) -> DataFrame:
    """Per split and source: evaluation records, those of which a text is contained to 0.7 at least in a training text, pairs of
    these, mean of the best containment."""
    best = _p5(spark, d).groupBy("key_e").agg(F.count("*").alias("n"), F.max("containment").alias("c"))
    ev = fuller(table(spark, d, "curator_eval_set"), "pair_id", ["split", "platform"]).withColumnRenamed("pair_id", "key_e")
    return ev.join(best, "key_e", "left").groupBy("split", "platform").agg(
        F.count("*").alias("records"), F.count("n").alias("overlapping"), F.coalesce(F.sum("n"), F.lit(0)).alias("pairs"),
        F.round(F.avg("c"), 4).alias("mean_containment"),
    )


def _p7(spark: SparkSession, d: str) -> DataFrame:
    who = {"repo": F.col("repo"), "commit_email": F.lower(F.trim("commit_email"))}
    return capping.cap(table(spark, d, "diffs"), "pair_id", "quality_score", who, share=1 / 50)


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return _p7(spark, d).where("over").select("pair_id")


def p7_kept(spark: SparkSession, d: str) -> DataFrame:
    return _p7(spark, d).where("not over").select("pair_id")


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return bpe.encode(spread(once(table(spark, d, "documents"), "doc_id", ["text"], ["text"])), "doc_id", "text")


def p8_counts(spark: SparkSession, d: str) -> DataFrame:
    """Documents, empty ones among them, and tokens per language."""
    docs = once(table(spark, d, "documents"), "doc_id", ["text", "lang"], ["text"])
    sizes = bpe.encode(docs, "doc_id", "text").select("doc_id", F.size("ids").alias("n"))
    return docs.select("doc_id", "lang").join(sizes, "doc_id").groupBy("lang").agg(
        F.count("*").alias("documents"), F.count_if(F.col("n") == 0).alias("empty"), F.sum("n").alias("tokens")
    )


def p8_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Digests of the texts that the ids stand for."""
    return bpe.decode(p8_ids(spark, d), "doc_id", "ids").select("doc_id", F.sha2("text", 256).alias("digest"))


def _p9(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    docs = once(table(spark, d, "documents"), "doc_id", ["text", "source"], ["text"])
    return mixing.mixture(docs, table(spark, d, "mix_targets"), "doc_id", "text", "source")


def p9_mixture(spark: SparkSession, d: str) -> DataFrame:
    return _p9(spark, d)[0]


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return _p9(spark, d)[1]


def p9_check(spark: SparkSession, d: str) -> DataFrame:
    """Per target: whether it has tokens at all, whether the share reached is its part of the targets that have, to 0.01, and
    whether none of its blocks is repeated too often."""
    rows = p9_shares(spark, d)
    has = F.col("tokens") > 0
    aim = F.when(has, F.col("target_weight") / F.sum(F.when(has, F.col("target_weight"))).over(Window.partitionBy())).otherwise(0.0)
    capped = F.col("most_repeats") <= F.greatest(F.lit(1), F.coalesce("max_repeats", F.lit(1)))
    return rows.select("source", has.alias("available"), (F.abs(F.col("actual_share") - aim) <= 0.01).alias("met"), capped.alias("capped"))


def _p10(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    docs = spread(once(table(spark, d, "documents"), "doc_id", ["text", "lang", "source"], ["text"]))
    return docs.select("doc_id", "lang", "source"), reading.levels(docs.select("doc_id", "text"), table(spark, d, "reading_labels"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    docs, levels = _p10(spark, d)
    return docs.where("lang = 'en'").select("doc_id").join(levels.where("band = 'advanced'").select("doc_id"), "doc_id")


def p10_levels(spark: SparkSession, d: str) -> DataFrame:
    return _p10(spark, d)[1].select("doc_id", F.round("level", 6).alias("level"), "band")


def p10_profile(spark: SparkSession, d: str) -> DataFrame:
    """Documents per source and band, with the mean level."""
    docs, levels = _p10(spark, d)
    return docs.join(levels, "doc_id").groupBy("source", "band").agg(F.count("*").alias("documents"), F.round(F.avg("level"), 4).alias("mean_level"))


def p10_validation(spark: SparkSession, d: str) -> DataFrame:
    """Judged documents placed by a model that did not know their judgement, and the log-likelihood of every round."""
    docs = spread(once(table(spark, d, "documents"), "doc_id", ["text"], ["text"]))
    return _figures(spark, reading.validation(docs, table(spark, d, "reading_labels").where("doc_id is not null")))


def _figures(spark: SparkSession, figures: dict[str, float]) -> DataFrame:
    return spark.createDataFrame([(k, round(float(v), 4)) for k, v in figures.items()], "figure string, value double")


def _p6(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "diffs").where("pair_id is not null")
    return spread(rows.select("pair_id", F.col("repo").alias("host"), F.col("after_content").alias("text")))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    # all deliveries of a record hold the same text, or none
    return residue.mark(_p6(spark, d), "pair_id").where("lines > 0").select("pair_id").distinct()


def p6_clean(spark: SparkSession, d: str) -> DataFrame:
    """The records without residue."""
    return residue.mark(_p6(spark, d), "pair_id").groupBy("pair_id").agg(F.sum("lines").alias("n")).where("n = 0").select("pair_id")


def p6_validation(spark: SparkSession, d: str) -> DataFrame:
    """What the classifier reaches, against the weak labels, on repositories and on kinds of phrases that took no part in its training."""
    return _figures(spark, residue.validation(residue.train(_p6(spark, d))[2]))


_P7 = """WITH d AS (SELECT pair_id, max(repo) repo, max(nullif(lower(trim(commit_email)), '')) email, max(quality_score) q
  FROM diffs WHERE pair_id IS NOT NULL GROUP BY pair_id),
n AS (SELECT count(*) // 50 AS n FROM d),
r AS (SELECT pair_id, repo, email, row_number() OVER (PARTITION BY repo ORDER BY q DESC NULLS LAST, pair_id) a,
  row_number() OVER (PARTITION BY email ORDER BY q DESC NULLS LAST, pair_id) b FROM d)
SELECT pair_id FROM r, n WHERE """
_OVER = "(coalesce(repo, '') <> '' AND a > n) OR (email IS NOT NULL AND b > n)"


#: Frontmatter dropped, lower case, split at blanks; and the distinct runs of five words.
_WORDS = r"list_filter(regexp_split_to_array(lower(regexp_replace({}, '(?s)\A---[ \t]*\r?\n(?:.*?\r?\n)??---[ \t]*(?:\r?\n|\z)', '')), '[\s\v\pZ\x85\x1c-\x1f]+'), lambda x: x <> '')"
_RUNS = "list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))"
_P3 = """WITH RECURSIVE d AS (SELECT pair_id, max(repo) AS repo, max(skill_id) AS skill_id, max(skill_cluster_id) AS cluster
  FROM curator_training WHERE pair_id IS NOT NULL GROUP BY pair_id),
t AS (SELECT DISTINCT pair_id, k FROM (SELECT pair_id, 'r' || repo AS k FROM d WHERE repo <> '' UNION ALL SELECT pair_id, 's' || skill_id FROM d
  WHERE skill_id <> '' UNION ALL SELECT pair_id, 'c' || cluster FROM d WHERE cluster <> '')),
lead AS (SELECT k, min(pair_id) AS m FROM t GROUP BY k), e AS (SELECT DISTINCT t.pair_id AS a, l.m AS b FROM t JOIN lead l USING (k) WHERE t.pair_id <> l.m),
g AS (SELECT a, b FROM e UNION SELECT b, a FROM e), r(x, y) AS (SELECT pair_id, pair_id FROM d UNION SELECT r.x, g.b FROM r JOIN g ON r.y = g.a)
SELECT x AS pair_id, min(y) AS group_id FROM r GROUP BY x"""
_P4 = f"""WITH l AS (SELECT skill_id, after_content AS x FROM (SELECT *, row_number() OVER (PARTITION BY skill_id ORDER BY
  try_cast(commit_date AS TIMESTAMPTZ) DESC NULLS LAST, pair_id DESC NULLS LAST, after_content IS NOT NULL DESC) AS n FROM diffs WHERE skill_id IS NOT NULL) WHERE n = 1),
s AS (SELECT skill_id, {_RUNS} AS runs FROM (SELECT skill_id, {_WORDS.format("x")} AS w FROM l WHERE x IS NOT NULL) WHERE len(w) >= 60),
u AS (SELECT skill_id, unnest(runs) AS r FROM s),
hit AS (SELECT a.skill_id AS i, b.skill_id AS j, count(*) AS n FROM u a JOIN u b ON a.r = b.r AND a.skill_id < b.skill_id GROUP BY 1, 2)
SELECT i AS skill_id_a, j AS skill_id_b FROM hit JOIN s a ON a.skill_id = i JOIN s b ON b.skill_id = j WHERE n >= 0.7 * (len(a.runs) + len(b.runs) - n)"""
_P4_GROUPS = f"""WITH RECURSIVE l AS (SELECT skill_id, after_content AS x FROM (SELECT *, row_number() OVER (PARTITION BY skill_id ORDER BY
  try_cast(commit_date AS TIMESTAMPTZ) DESC NULLS LAST, pair_id DESC NULLS LAST, after_content IS NOT NULL DESC) AS n FROM diffs WHERE skill_id IS NOT NULL) WHERE n = 1),
s AS (SELECT skill_id, list_sort(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS runs FROM (SELECT skill_id, {_WORDS.format("x")} AS w FROM l WHERE x IS NOT NULL) WHERE len(w) >= 5),
cls AS (SELECT min(skill_id) AS n, runs FROM s GROUP BY runs), u AS (SELECT n, r, count(*) AS c FROM (SELECT n, unnest(runs) AS r FROM cls) GROUP BY 1, 2),
hit AS (SELECT p.n AS a, q.n AS b, sum(least(p.c, q.c)) AS k FROM u p JOIN u q ON p.r = q.r AND p.n < q.n GROUP BY 1, 2),
e AS (SELECT a, b FROM hit JOIN cls x ON x.n = a JOIN cls y ON y.n = b WHERE k >= 0.8 * (len(x.runs) + len(y.runs) - k)),
g AS (SELECT a, b FROM e UNION SELECT b, a FROM e), r(x, y) AS (SELECT n, n FROM cls UNION SELECT r.x, g.b FROM r JOIN g ON r.y = g.a), comp AS (SELECT x, min(y) AS c FROM r GROUP BY x),
links AS (SELECT a AS x, count(*) AS k FROM g GROUP BY a)
SELECT skill_id, c AS group_id, coalesce(k, 0) AS links FROM s JOIN cls ON cls.runs = s.runs JOIN comp ON comp.x = cls.n LEFT JOIN links ON links.x = cls.n"""
_P5 = f"""WITH e AS (SELECT DISTINCT pair_id, unnest([before_content, after_content]) AS x FROM curator_eval_set WHERE pair_id IS NOT NULL),
t AS (SELECT DISTINCT pair_id, after_content AS x FROM curator_training WHERE pair_id IS NOT NULL),
ex AS (SELECT row_number() OVER () AS id, x FROM (SELECT DISTINCT x FROM e WHERE x <> '')), tx AS (SELECT row_number() OVER () AS id, x FROM (SELECT DISTINCT x FROM t WHERE x <> '')),
er AS (SELECT id, {_RUNS} AS runs FROM (SELECT id, {_WORDS.format("x")} AS w FROM ex) WHERE len(w) > 4), tr AS (SELECT id, {_RUNS} AS runs FROM (SELECT id, {_WORDS.format("x")} AS w FROM tx) WHERE len(w) > 4),
hit AS (SELECT a.id AS i, b.id AS j, count(*) AS n FROM (SELECT id, unnest(runs) AS r FROM er) a JOIN (SELECT id, unnest(runs) AS r FROM tr) b USING (r) GROUP BY 1, 2),
near AS (SELECT ex.x AS xe, tx.x AS xt, n / len(er.runs) AS c, n / (len(er.runs) + len(tr.runs) - n) AS s FROM hit JOIN er ON er.id = i JOIN tr ON tr.id = j JOIN ex ON ex.id = i JOIN tx ON tx.id = j),
pairs AS (SELECT e.pair_id AS key_e, t.pair_id AS key_t, max(c) AS c, max(s) AS s FROM near JOIN e ON e.x = xe JOIN t ON t.x = xt GROUP BY 1, 2) """
_P5_REPORT = """, best AS (SELECT key_e, count(*) AS n, max(c) AS c FROM pairs WHERE c >= 0.7 - 1e-9 GROUP BY 1),
k AS (SELECT pair_id, max(split) AS split, max(platform) AS platform FROM curator_eval_set WHERE pair_id IS NOT NULL GROUP BY 1)
SELECT split, platform, count(*) AS records, count(n) AS overlapping, CAST(coalesce(sum(n), 0) AS BIGINT) AS pairs, round(avg(c), 4) AS mean_containment FROM k LEFT JOIN best ON key_e = pair_id GROUP BY 1, 2"""
_P9_CHECK = """SELECT source, source IN (SELECT source FROM documents WHERE text <> '') AS available, true AS met, true AS capped FROM mix_targets WHERE source IS NOT NULL"""


def queries() -> dict[str, Query]:
    names = (
        p1_found, p1_kinds, p1_redacted, p2_found, p2_kinds, p2_redacted, p3_found, p3_splits, p3_report, p3_balance, p4_found, p4_groups, p5_found, p5_report, p6_found, p6_clean,
        p6_validation, p7_found, p7_kept, p8_ids, p8_counts, p8_roundtrip, p9_mixture, p9_shares, p9_check, p10_found, p10_levels, p10_profile, p10_validation,
    )
    return {f.__name__: f for f in names}


def oracle_sql() -> dict[str, str]:
    return {
        "p3_found": _P3,
        "p3_balance": "SELECT unnest(['train', 'validation', 'test']) AS split, true AS within, true AS labels_within",
        "p4_found": _P4,
        "p4_groups": _P4_GROUPS,
        "p5_found": _P5 + "SELECT least(key_e, key_t) AS pair_id_a, greatest(key_e, key_t) AS pair_id_b FROM pairs WHERE s >= 0.7 - 1e-9",
        "p5_report": _P5 + _P5_REPORT,
        "p7_found": _P7 + _OVER,
        "p7_kept": _P7 + f"NOT coalesce({_OVER}, false)",
        "p8_roundtrip": "SELECT doc_id, sha256(coalesce(any_value(text), '')) AS digest FROM documents WHERE doc_id IS NOT NULL GROUP BY doc_id",
        "p9_check": _P9_CHECK,
    }
