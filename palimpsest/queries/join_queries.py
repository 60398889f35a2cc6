"""Queries over side tables: provenance, journals, pull requests, repositories, bundles, unions; each with its SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from palimpsest.functions.text import basename, cursor_rule, parent_name, stable_id, text_of
from palimpsest.operators import dims
from palimpsest.operators.chain import latest_per_key
from palimpsest.operators.records import fuller
from palimpsest.plans.revisions import repositories, revisions
from palimpsest.queries.revision_queries import KIND, REPOS, REV
from palimpsest.session import table

PLATFORMS = ("claude_skill", "opencode_skill", "hermes_skill", "openclaw_skill", "cursor_rule")

#: Pull requests made up from the documents of a source: every fifth has one, naming its own and neighbouring commits.
_PRS = """SELECT source AS repo, CAST(doc_id AS INT) AS pr_number, concat('PR for ', CAST(doc_id AS STRING)) AS pr_title,
  sha1(concat(source, ':', CAST(doc_id AS STRING))) AS head_sha,
  CASE WHEN doc_id % 4 = 0 THEN sha1(concat(source, ':', CAST(doc_id AS STRING))) WHEN doc_id % 4 = 2 THEN sha1(concat(source, ':', CAST(nxt AS STRING)))
       WHEN doc_id % 4 = 3 THEN sha1(concat(source, ':', CAST(prv AS STRING))) END AS merge_sha
FROM (SELECT doc_id, source, lead(doc_id) OVER (PARTITION BY source ORDER BY doc_id) AS nxt, lag(doc_id) OVER (PARTITION BY source ORDER BY doc_id) AS prv FROM {docs}) x WHERE doc_id % 5 = 0"""


def seed_provenance(spark, d):
    df = revisions(spark, d, ["repo"])
    lists = table(spark, d, "repos").select("repo", "source_seed")
    named = [(s, lists.where(F.col("source_seed") == s).select("repo")) for s in ("huzey", "expansion")]
    return dims.seed_of(df, "repo", named).groupBy("source_seed").agg(F.count("*").alias("n"))


def new_repos(spark, d):
    return table(spark, d, "diffs").select("repo").distinct().join(table(spark, d, "repos").select("repo"), "repo", "left_anti")


def _journal(spark, d):
    e = table(spark, d, "events").select("user_id", "ts", "event_id", F.col("event_type").alias("status"))
    return latest_per_key(e, ["user_id"], ["ts", "event_id"])


def latest_entries(spark, d):
    return _journal(spark, d).select("user_id", "event_id", "status")


def pending_work(spark, d):
    wanted = table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"))
    return dims.pending(wanted, _journal(spark, d), "user_id", ("click", "view"))


def first_claim_platform(spark, d):
    rank = F.array_position(F.array(*map(F.lit, PLATFORMS)), F.col("platform"))
    rows = table(spark, d, "repos").where("platform is not null").select("repo", "platform", rank.alias("r"))
    return rows.groupBy("repo").agg(F.min_by("platform", F.struct("r", "platform")).alias("platform"))


def _matched(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source")
    prs = spark.sql(_PRS, docs=docs)
    by_sha = dims.pull_requests(prs, "repo", "pr_number", "merge_sha", "head_sha", ["pr_title"])
    rows = docs.select("doc_id", F.col("source").alias("repo"), F.sha1(F.concat_ws(":", "source", F.col("doc_id").cast("string"))).alias("sha"))
    return rows.join(by_sha, ["repo", "sha"], "left")


def pr_join(spark, d):
    return _matched(spark, d).select("doc_id", "pr_number", "pr_title", "pr_match_kind")


def pr_match_stats(spark, d):
    return _matched(spark, d).groupBy("pr_match_kind").agg(F.count("*").alias("n"))


def repo_metadata_join(spark, d):
    df = revisions(spark, d, ["repo"])
    facts = repositories(spark, d).withColumn("__k", F.lit(True))
    status = F.when(F.col("__k").isNull(), "not_attempted").otherwise(F.col("fetch_status"))
    return df.join(facts, "repo", "left").groupBy(status.alias("status"), F.col("license_spdx").isNotNull().alias("licensed")).agg(F.count("*").alias("n"))


def conditional_relabel(spark, d):
    from palimpsest.plans.revisions import with_intent

    df = with_intent(revisions(spark, d, ["commit_subject", "is_initial", "lines_added", "lines_removed", "char_delta", "intent_source"]))
    labels = df.where("coalesce(commit_subject, '') <> ''").select("pair_id", F.lit("other").alias("label"))
    new = {"intent_class": F.col("label"), "intent_confidence": F.lit(0.85).cast("float"), "intent_source": F.lit("llm")}
    out = dims.relabel(df, labels, "pair_id", F.col("intent_class") == "unknown", new)
    return out.groupBy("intent_class", F.round(F.col("intent_confidence").cast("double"), 2).alias("confidence")).agg(F.count("*").alias("n"))


def _bundles(spark, d):
    return fuller(table(spark, d, "bundled"), "skill_id", ["repo", "skill_dir", "skill_path", "bundled_files", "bundled_count", "bundled_text_count"], skip=("bundled_files",))


def bundled_counts(spark, d):
    f = F.coalesce("bundled_files", F.array().cast(dict(table(spark, d, "bundled").dtypes)["bundled_files"]))
    text = F.filter(f, lambda x: x["content"].isNotNull())
    size = F.aggregate(f, F.lit(0).cast("bigint"), lambda s, x: s + F.coalesce(x["size"], F.lit(0)))
    return _bundles(spark, d).select("skill_id", F.size(f).alias("files"), F.size(text).alias("texts"), size.alias("bytes"))


def bundled_prefix_join(spark, d):
    """Files of bundles with the first skill of their repository, by path, whose directory holds them. A skill's own file is not
    among its files, but may be among those of a skill around it; so skill files take part here."""
    b = _bundles(spark, d).where("skill_dir is not null and skill_path is not null and repo is not null")
    path = F.concat(F.when(F.col("skill_dir") != "", F.concat("skill_dir", F.lit("/"))).otherwise(""), "p")
    files = b.select("repo", F.explode(F.transform("bundled_files", lambda x: x["path"])).alias("p"), "skill_dir").select("repo", path.alias("path"))
    files = files.union(b.select("repo", "skill_path")).distinct()
    dirs = b.select("repo", "skill_dir", "skill_path").distinct()
    out = dims.below_directory(files, "path", dirs, "skill_dir", ["repo"], own="skill_path", order="skill_path")
    return out.select("repo", "path", F.col("skill_path").alias("held_by"))


def skill_names(spark, d):
    df = table(spark, d, "bundled").where("skill_path is not null").select("skill_path").distinct()
    p = F.col("skill_path")
    return df.select("skill_path", parent_name(p).alias("directory"), basename(p).alias("base"), cursor_rule(p).alias("rule"), (F.lower(basename(p)) == "skill.md").alias("skill"))


def aligned_union(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    s = table(spark, d, "supplier").select(F.col("s_suppkey").cast("int").alias("key"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("extra"))
    return dims.aligned_union(c, s).select("key", "name", F.round("balance", 2).alias("balance"))


def left_wins(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"))
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"))
    return dims.left_wins(s, c, "key")


def distinct_sources(spark, d):
    return table(spark, d, "documents").where("source is not null").select("source").distinct().orderBy("source")


def top_licenses(spark, d):
    df = repositories(spark, d).where("coalesce(license_spdx, '') <> ''").groupBy("license_spdx").agg(F.count("*").alias("n"))
    return df.orderBy(F.desc("n"), "license_spdx").limit(10)


def license_status(spark, d):
    df = table(spark, d, "repos")
    return df.agg(
        F.count("*").alias("rows"), F.count_if(F.col("fetch_status") == "ok").alias("ok"), F.count_if(F.col("fetch_status") == "not_found").alias("not_found"),
        F.count_if(F.col("fetch_status") == "error").alias("error"), F.count_if(text_of("license_spdx") != "").alias("licensed"),
    )


def provenance_lists(spark, d):
    df = table(spark, d, "documents").where("source is not null and skill_path is not null")
    return df.groupBy("source").agg(F.array_join(F.array_sort(F.collect_set("platform")), ",").alias("platforms"), F.countDistinct("skill_path").alias("paths"))


def json_props(spark, d):
    k = F.from_json("props", "k double")["k"]
    return table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.count(k).alias("with_k"), F.round(F.avg(k), 4).alias("mean_k"))


def event_windows(spark, d):
    from palimpsest.streaming.events import windowed_counts

    return windowed_counts(table(spark, d, "events")).select("start", "event_type", "n", F.round("total", 2).alias("total"))


QUERIES = {
    f.__name__: f
    for f in (
        seed_provenance, new_repos, latest_entries, pending_work, first_claim_platform, pr_join, pr_match_stats, repo_metadata_join, conditional_relabel, bundled_counts, bundled_prefix_join, skill_names,
        aligned_union, left_wins, distinct_sources, top_licenses, license_status, provenance_lists, json_props, event_windows,
    )
}

_BUNDLES = "b AS (SELECT skill_id, any_value(repo) AS repo, any_value(skill_dir) AS skill_dir, any_value(skill_path) AS skill_path, any_value(bundled_files) AS bundled_files FROM bundled WHERE skill_id IS NOT NULL GROUP BY skill_id)"
_PR_SQL = f"""WITH prs AS ({_PRS.format(docs='documents')}), keys AS (SELECT repo, pr_number, pr_title, 0 AS k, merge_sha AS sha, 'merge_commit_sha' AS pr_match_kind FROM prs
  UNION ALL SELECT repo, pr_number, pr_title, 1, head_sha, 'head_sha' FROM prs),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY repo, sha ORDER BY pr_number, k) AS n FROM keys WHERE sha IS NOT NULL) WHERE n = 1),
m AS (SELECT doc_id, pr_number, pr_title, pr_match_kind FROM documents d LEFT JOIN best ON best.repo = d.source AND best.sha = sha1(concat(d.source, ':', CAST(d.doc_id AS STRING))))"""
_LATEST = "SELECT user_id, event_id, event_type AS status FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1"
SQL = {
    "seed_provenance": f"WITH {REV} SELECT source_seed, count(*) AS n FROM (SELECT CASE WHEN repo IN (SELECT repo FROM repos WHERE source_seed = 'huzey') THEN 'huzey' WHEN repo IN (SELECT repo FROM repos WHERE source_seed = 'expansion') THEN 'expansion' ELSE 'other' END AS source_seed FROM rev) GROUP BY 1",
    "new_repos": "SELECT DISTINCT repo FROM diffs WHERE repo NOT IN (SELECT repo FROM repos WHERE repo IS NOT NULL)",
    "latest_entries": _LATEST,
    "pending_work": f"SELECT c_custkey AS user_id FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM ({_LATEST}) WHERE status IN ('click', 'view') AND user_id IS NOT NULL)",
    "first_claim_platform": f"SELECT repo, arg_min(platform, list_position({list(PLATFORMS)!r}, platform)) AS platform FROM repos WHERE platform IS NOT NULL GROUP BY repo",
    "pr_join": _PR_SQL + " SELECT * FROM m",
    "pr_match_stats": _PR_SQL + " SELECT pr_match_kind, count(*) AS n FROM m GROUP BY 1",
    "repo_metadata_join": f"WITH {REV}, {REPOS.replace('SELECT repo, license_spdx, stars, pushed_at, true', 'SELECT repo, license_spdx, fetch_status, true')} SELECT CASE WHEN known IS NULL THEN 'not_attempted' ELSE rp.fetch_status END AS status, rp.license_spdx IS NOT NULL AS licensed, count(*) AS n FROM rev LEFT JOIN rp USING (repo) GROUP BY 1, 2",
    "conditional_relabel": f"WITH {REV}, {KIND} SELECT intent_class, confidence, count(*) AS n FROM (SELECT CASE WHEN k = 'unknown' AND s <> '' THEN 'other' ELSE k END AS intent_class, CAST(CASE WHEN k = 'unknown' AND s <> '' THEN 0.85 ELSE conf END AS DOUBLE) AS confidence FROM kind) GROUP BY 1, 2",
    "bundled_counts": f"WITH {_BUNDLES} SELECT skill_id, CAST(coalesce(len(bundled_files), 0) AS INT) AS files, CAST(coalesce(len(list_filter(bundled_files, lambda f: f.content IS NOT NULL)), 0) AS INT) AS texts, CAST(coalesce(list_sum(list_transform(bundled_files, lambda f: f.size)), 0) AS BIGINT) AS bytes FROM b",
    "bundled_prefix_join": f"WITH {_BUNDLES}, k AS (SELECT * FROM b WHERE skill_dir IS NOT NULL AND skill_path IS NOT NULL AND repo IS NOT NULL), f AS (SELECT repo, CASE WHEN skill_dir <> '' THEN skill_dir || '/' ELSE '' END || p AS path FROM (SELECT repo, skill_dir, unnest(list_transform(bundled_files, lambda f: f.path)) AS p FROM k) UNION SELECT repo, skill_path FROM k) SELECT f.repo, f.path, min(g.skill_path) AS held_by FROM f JOIN (SELECT DISTINCT repo, skill_dir, skill_path FROM k) g ON g.repo = f.repo AND g.skill_path <> f.path AND ((g.skill_dir <> '' AND starts_with(f.path, g.skill_dir || '/')) OR (g.skill_dir = '' AND NOT contains(f.path, '/'))) GROUP BY 1, 2",
    "skill_names": r"SELECT DISTINCT skill_path, coalesce(string_split(skill_path, '/')[len(string_split(skill_path, '/')) - 1], '') AS directory, string_split(skill_path, '/')[-1] AS base, lower(string_split(skill_path, '/')[-1]) = '.cursorrules' OR regexp_matches(lower(string_split(skill_path, '/')[-1]), '^\.cursorrules.*\.(md|txt|mdx)$') OR (list_contains(string_split(lower(skill_path), '/'), '.cursor') AND list_contains(string_split(lower(skill_path), '/'), 'rules') AND regexp_matches(lower(skill_path), '\.(mdc|md)$')) AS rule, lower(string_split(skill_path, '/')[-1]) = 'skill.md' AS skill FROM bundled WHERE skill_path IS NOT NULL",
    "aligned_union": "SELECT CAST(c_custkey AS BIGINT) AS key, c_name AS name, round(c_acctbal, 2) AS balance FROM customer UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier",
    "left_wins": "SELECT s_suppkey AS key, s_name AS name FROM supplier UNION ALL SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)",
    "distinct_sources": "SELECT DISTINCT source FROM documents WHERE source IS NOT NULL ORDER BY source",
    "top_licenses": f"WITH {REPOS} SELECT license_spdx, count(*) AS n FROM rp WHERE coalesce(license_spdx, '') <> '' GROUP BY 1 ORDER BY n DESC, license_spdx LIMIT 10",
    "license_status": "SELECT count(*) AS rows, count(*) FILTER (fetch_status = 'ok') AS ok, count(*) FILTER (fetch_status = 'not_found') AS not_found, count(*) FILTER (fetch_status = 'error') AS error, count(*) FILTER (coalesce(license_spdx, '') <> '') AS licensed FROM repos",
    "provenance_lists": "SELECT source, array_to_string(list_sort(list(DISTINCT platform) FILTER (platform IS NOT NULL)), ',') AS platforms, count(DISTINCT skill_path) AS paths FROM documents WHERE source IS NOT NULL AND skill_path IS NOT NULL GROUP BY source",
    "json_props": "SELECT event_type, count(*) AS n, count(try_cast(props::json->>'k' AS DOUBLE)) AS with_k, round(avg(try_cast(props::json->>'k' AS DOUBLE)), 4) AS mean_k FROM events GROUP BY event_type",
    "event_windows": "SELECT time_bucket(INTERVAL '1 hour', ts::timestamp) AS start, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2",
}
