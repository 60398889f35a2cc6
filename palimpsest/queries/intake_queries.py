"""Queries over raw deliveries, and of the small operators around the corpus; each with its SQL. Patterns in this SQL are written
out, not taken from the engine."""

from __future__ import annotations

from pyspark.sql import functions as F

from palimpsest.functions.structure import diff_summary, parse_skill
from palimpsest.functions.text import archive_sha, cursor_rule_found, duration, iso_time, rule_name, safe_name, short_id, text_of
from palimpsest.operators import chain, dims, subset
from palimpsest.plans import intake, labelling
from palimpsest.plans.revisions import revisions, tagged, with_intent
from palimpsest.queries.join_queries import PLATFORMS, _journal
from palimpsest.queries.revision_queries import FLAGS, KIND, REV, TAGGED, WITH, _INTENT, _evaluable
from palimpsest.session import table


def _raw(spark, d):
    return table(spark, d, "diffs").select(*intake.RAW, "platform")


def _seeds(spark, d):
    lists = table(spark, d, "repos")
    return [(s, lists.where(F.col("source_seed") == s).select("repo")) for s in ("huzey", "expansion")]


def normalised_raw(spark, d):
    """The raw columns of diffs as records again; texts as hashes."""
    df = intake.normalised(_raw(spark, d), F.col("platform"), _seeds(spark, d))
    texts = {"before_content": F.sha2("before_content", 256), "after_content": F.sha2("after_content", 256), "quality_tags": F.array_join("quality_tags", ",")}
    return df.withColumns(texts).withColumn("intent_confidence", F.round(F.col("intent_confidence").cast("double"), 2))


def platform_added(spark, d):
    """Editor rules added to the skills that are held, with the duplicates that this makes, per platform and tag."""
    raw = _raw(spark, d)
    held = intake.normalised(raw.where("platform <> 'cursor_rule'"), F.col("platform"))
    out = intake.add_platform(held, raw.where("platform = 'cursor_rule'").drop("platform"), "cursor_rule")
    return out.groupBy("platform").agg(F.count("*").alias("n"), F.count_if(F.array_contains("quality_tags", "duplicate_after")).alias("repeated_texts"), F.count_if(F.array_contains("quality_tags", "duplicate_pair")).alias("repeated_edits"))


def bundled_normalised(spark, d):
    df = intake.bundled(table(spark, d, "bundled").drop("skill_id")).distinct()
    f = "bundled_files"
    total = F.aggregate(f, F.lit(0).cast("bigint"), lambda s, x: s + x["size"])
    return df.select(
        "skill_id", "skill_path", "skill_dir", "skill_name", "head_sha", "bundled_count", "bundled_text_count", F.size(f).alias("files"), total.alias("bytes"),
        F.array_join(F.transform(f, lambda x: x["path"]), "|").alias("paths"), F.size(F.filter(f, lambda x: x["binary_or_oversize"])).alias("binary"),
    )


REQUIRED = ("pair_id", "skill_id", "repo", "intent_text", "commit_subject")
OPTIONAL = ("platform", "pr_number", "skill_semantic_cluster_id", "quality_score", "license_spdx", "diff_summary", "stars")


def optional_columns(spark, d):
    """The columns of a subset: those required, and of the optional ones those that are there."""
    df = table(spark, d, "curator_training").distinct()
    return subset.present(df, REQUIRED, OPTIONAL).withColumn("quality_score", F.round(F.col("quality_score").cast("double"), 4))


def eval_candidates_first(spark, d):
    df = with_intent(revisions(spark, d, ["commit_subject", "is_initial", "lines_added", "lines_removed", "char_delta", "pr_title"], {
        "b": F.length(text_of("before_content")), "a": F.length(text_of("after_content")),
        "ok": subset.evaluable_first(F.col("before_content"), F.col("after_content"), subset.intent_text(F.col("pr_title"), F.col("commit_subject"))),
    }))
    return df.where("ok").select("pair_id", "intent_class", "b", "a")


def rules_found(spark, d):
    """Paths of the corpus, and forms that it lacks, by the looser rule of searches, with the name an editor rule has."""
    paths = table(spark, d, "diffs").select(F.col("skill_path").alias("p")).where("p is not null").distinct()
    more = F.explode(F.array(F.col("p"), F.concat("p", F.lit(".mdc")), F.concat(F.lit(".cursor/rules/"), "p"), F.concat("p", F.lit("/.cursorrules-x.txt")), F.concat("p", F.lit("/.cursorrules"))))
    df = paths.select(more.alias("path")).distinct()
    return df.select("path", cursor_rule_found(F.col("path")).alias("found"), rule_name(F.col("path")).alias("name"))


def card_examples(spark, d):
    """The subsets that the data card names, counted."""
    b, a = F.col("before_content"), F.col("after_content")
    cols = ["platform", "pr_title", "char_delta", "intent_class", "quality_score", "is_canonical"]
    df = revisions(spark, d, cols, {"diff_summary": diff_summary(b, a, parse_skill(b), parse_skill(a))})
    some = {
        "one_platform": {"platform": "claude_skill"}, "with_pr": {"with_pr": True}, "small_change": {"most_change": 5000, "with_pr": True}, "edits": {"intents": ("feat", "fix")},
        "good": {"least_score": 0.7}, "canonical": {"canonical": True}, "structural": {"edit_kinds": ("structural", "both")},
    }
    out = None
    for name, how in some.items():
        one = subset.card(df, **how).agg(F.count("*").alias("n")).select(F.lit(name).alias("subset"), "n")
        out = one if out is None else out.union(one)
    return out


def platform_guard(spark, d):
    """Which platforms may be added: those that no revision has."""
    have = table(spark, d, "diffs").select("platform").distinct().withColumn("present", F.lit(True))
    names = spark.createDataFrame([(p,) for p in (*PLATFORMS, "new_rule")], "platform string")
    return names.join(have, "platform", "left").select("platform", F.coalesce("present", F.lit(False)).alias("present"))


def cluster_map_defaults(spark, d):
    """A map of clusters joined to revisions, with either default."""
    rows = table(spark, d, "curator_training").where("coalesce(skill_cluster_id, '') <> '' and skill_id is not null")
    one = rows.groupBy("skill_id").agg(F.max("skill_cluster_id").alias("c"))
    first = one.groupBy("c").agg(F.min("skill_id").alias("m"))
    known = one.join(first, "c").select("skill_id", F.col("c").alias("near"), (F.col("skill_id") == F.col("m")).alias("near_canonical"))
    df = revisions(spark, d, ["skill_id"])
    df = dims.with_clusters(df, known, "skill_id", "near", "near_canonical", True)
    other = known.select("skill_id", F.col("near").alias("semantic"), F.col("near_canonical").alias("semantic_canonical"))
    return dims.with_clusters(df, other, "skill_id", "semantic", "semantic_canonical", False).select("pair_id", "near", "near_canonical", "semantic", "semantic_canonical")


def pending_variants(spark, d):
    """Work left to do by three rules: done only by success; no retry of anything tried; no retry of failures."""
    wanted = table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"))
    j, done = _journal(spark, d), ("click", "view")
    variants = {"retry": {}, "untried": {"retry": False}, "no_failed": {"failed": ("purchase",), "retry": False}}
    out = None
    for name, how in variants.items():
        one = dims.pending(wanted, j, "user_id", done, **how).select(F.lit(name).alias("variant"), "user_id")
        out = one if out is None else out.union(one)
    return out


def limited_work(spark, d):
    return chain.first_n(table(spark, d, "customer").join(_journal(spark, d).select(F.col("user_id").alias("c_custkey")), "c_custkey", "left_anti").select("c_custkey"), ["c_custkey"], 10)


def last_events(spark, d):
    return chain.last_n(table(spark, d, "events").select("event_id", "event_type", "ts"), ["ts", "event_id"], 4).select("event_id", "event_type")


def clean_per_shard(spark, d):
    """Records and clean edits per shard, a repository's file."""
    df = tagged(spark, d).withColumn("shard", safe_name(F.col("repo"))).where("shard is not null")
    return dims.shard_counts(df, subset.clean(df), "shard")


def known_repositories(spark, d):
    lists = table(spark, d, "repos")
    return dims.known_keys([lists.where("source_seed = 'huzey'"), lists.where("source_seed = 'expansion'"), table(spark, d, "curator_eval_set")], "repo")


def skill_paths(spark, d):
    """The distinct paths of every repository, in order."""
    df = table(spark, d, "diffs").where("repo is not null and skill_path is not null")
    return df.groupBy("repo").agg(F.array_sort(F.collect_set("skill_path")).alias("p")).select("repo", F.array_join("p", "|").alias("paths"), F.size("p").alias("n"))


def repository_provenance(spark, d):
    """Where every repository was found: its (platform, seed) pairs, in order."""
    df = table(spark, d, "repos").where("repo is not null").select("repo", F.struct(text_of("platform").alias("platform"), text_of("source_seed").alias("seed")).alias("x"))
    return df.groupBy("repo").agg(F.array_sort(F.collect_list("x")).alias("x")).select("repo", F.to_json("x").alias("found"))


def label_cost(spark, d):
    n = with_intent(revisions(spark, d, ["commit_subject", "is_initial", "lines_added", "lines_removed", "char_delta"])).where("intent_class = 'unknown'").agg(F.count("*").alias("n"))
    return n.select("n", labelling.cost(F.col("n")).alias("c")).select("n", "c.*")


def scalar_forms(spark, d):
    """Small forms of a repository's facts: short id, file name, ISO time, duration, the commit in an archive's name."""
    df = table(spark, d, "repos").where("repo is not null").select("repo", "stars", "pushed_at").distinct()
    fetched = F.try_to_timestamp(F.col("pushed_at"))
    root = F.concat(safe_name(F.col("repo")), F.lit("-"), F.left(F.sha1("repo"), F.lit(12)))
    return df.select(
        "repo", short_id(F.col("repo")).alias("short_id"), safe_name(F.col("repo")).alias("file"), iso_time(fetched).alias("pushed"),
        duration(F.coalesce("stars", F.lit(0)) * 37 + 59).alias("took"), archive_sha(root).alias("sha"), archive_sha(F.concat(root, F.lit("-x"))).alias("none"),
    )


def sample_row(spark, d):
    """One record of the evaluable edits, the first by key, long texts cut."""
    cut = lambda c: F.when(F.length(c) > 80, F.concat(F.left(c, F.lit(80)), F.lit("..."))).otherwise(c)
    df = _evaluable(spark, d).select("pair_id", "intent_class", cut(F.col("commit_subject")).alias("subject"), cut(F.col("after_content")).alias("text"))
    return chain.first_n(df, ["pair_id"], 1)


def labelled(spark, d):
    """Labels of unknown subjects by a stand-in for a model, which answers by the subject's length and not always in form."""

    def make():
        def client(asked: str) -> str:
            rows = [x.split(": ", 1) for x in asked.rsplit("\n\n", 1)[1].split("\n") if ": " in x]
            return "\n".join(f"{n}: {('docs', 'FIX', 'nonsense')[len(s) % 3]}" for n, s in rows)

        return client

    df = with_intent(revisions(spark, d, ["commit_subject", "is_initial", "lines_added", "lines_removed", "char_delta", "intent_source"]))
    asked = df.where("intent_class = 'unknown' and coalesce(commit_subject, '') <> '' and not contains(commit_subject, '\n')")
    out = labelling.apply_labels(df, labelling.labels(asked, "pair_id", "commit_subject", make, pause=0.0), "pair_id")
    return out.groupBy("intent_class", F.round(F.col("intent_confidence").cast("double"), 2).alias("confidence")).agg(F.count("*").alias("n"))


QUERIES = {
    f.__name__: f
    for f in (
        normalised_raw, platform_added, bundled_normalised, optional_columns, eval_candidates_first, rules_found, card_examples, platform_guard, cluster_map_defaults, pending_variants, limited_work,
        last_events, clean_per_shard, known_repositories, skill_paths, repository_provenance, label_cost, scalar_forms, sample_row, labelled,
    )
}

_id = lambda *c: "left(sha1(" + " || ".join(f"coalesce({x}, '') || chr(0)" for x in c) + "), 16)"
_SEED = "CASE WHEN repo IN (SELECT repo FROM repos WHERE source_seed = 'huzey') THEN 'huzey' WHEN repo IN (SELECT repo FROM repos WHERE source_seed = 'expansion') THEN 'expansion' ELSE 'other' END"
_SUBJECT = r"regexp_replace(coalesce(commit_subject, ''), '^[\s\pZ]+|[\s\pZ]+$', '', 'g')"
_NORMAL = f"""WITH {REV.replace('rev AS', 'rev0 AS', 1)}, rev AS (SELECT * REPLACE ({_SUBJECT} AS commit_subject, coalesce(after_content, '') AS after_content, {_id('repo', 'skill_path', 'before_sha', 'after_sha')} AS pair_id) FROM rev0
  WHERE repo IS NOT NULL AND skill_path IS NOT NULL AND after_sha IS NOT NULL), {KIND}, {FLAGS}, {TAGGED} """
_HELD = "platform <> 'cursor_rule'"
_PLATFORM = f"""WITH {REV}, h AS (SELECT *, sha256(coalesce(after_content, '')) AS ah, sha256(coalesce(before_content, '') || chr(0) || chr(1) || chr(2) || coalesce(after_content, '')) AS ph FROM rev),
o AS (SELECT *, row_number() OVER (PARTITION BY platform = 'cursor_rule', ah ORDER BY ts NULLS FIRST, pair_id) > 1 OR (platform = 'cursor_rule' AND ah IN (SELECT ah FROM h WHERE {_HELD})) AS a,
  row_number() OVER (PARTITION BY platform = 'cursor_rule', ph ORDER BY ts NULLS FIRST, pair_id) > 1 OR (platform = 'cursor_rule' AND ph IN (SELECT ph FROM h WHERE {_HELD})) AS p FROM h WHERE platform IS NOT NULL)
SELECT platform, count(*) AS n, count(*) FILTER (a) AS repeated_texts, count(*) FILTER (p) AS repeated_edits FROM o GROUP BY 1"""
_LATEST = "SELECT user_id, event_id, event_type AS status FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1 AND user_id IS NOT NULL"
_B, _A = "length(coalesce(before_content, ''))", "length(coalesce(after_content, ''))"
_BASE = "split_part(path, '/', -1)"
_STEM = rf"CASE WHEN regexp_matches({_BASE}, '^.+\.[^.]*$') THEN regexp_replace({_BASE}, '\.[^.]*$', '') ELSE {_BASE} END"


def _evaluable_sql() -> str:
    from palimpsest.queries.revision_queries import _EVAL

    return _EVAL


def _card_sql() -> str:
    from palimpsest.queries.text_queries import _SUMMARY

    some = {
        "one_platform": "platform = 'claude_skill'", "with_pr": "coalesce(pr_title, '') <> ''", "small_change": "abs(char_delta) < 5000 AND coalesce(pr_title, '') <> ''", "edits": "intent_class IN ('feat', 'fix')",
        "good": "round(quality_score::double, 6) >= 0.7", "canonical": "is_canonical", "structural": "edit_kind IN ('structural', 'both')",
    }
    return f"WITH {REV}, {_SUMMARY} " + " UNION ALL ".join(f"SELECT '{n}' AS subset, count(*) AS n FROM e WHERE {w}" for n, w in some.items())


def sql() -> dict[str, str]:
    return {
        "normalised_raw": _NORMAL + f"""SELECT pair_id, {_id('repo', 'skill_path')} AS skill_id, repo, {_SEED} AS source_seed, platform, skill_path, coalesce(skill_name, '') AS skill_name, before_sha, after_sha,
  sha256(before_content) AS before_content, sha256(after_content) AS after_content, commit_subject, coalesce(commit_author, '') AS commit_author, coalesce(commit_email, '') AS commit_email, coalesce(commit_date, '') AS commit_date,
  coalesce(lines_added, 0) AS lines_added, coalesce(lines_removed, 0) AS lines_removed, coalesce(char_delta, 0) AS char_delta, coalesce(is_initial, false) AS is_initial, k AS intent_class, CAST(conf AS DOUBLE) AS intent_confidence,
  'regex' AS intent_source, array_to_string(tags, ',') AS quality_tags FROM tagged""",
        "platform_added": _PLATFORM,
        "bundled_normalised": f"""SELECT DISTINCT {_id('repo', 'skill_path')} AS skill_id, skill_path, coalesce(skill_dir, '') AS skill_dir, coalesce(skill_name, '') AS skill_name, coalesce(head_sha, '') AS head_sha,
  coalesce(bundled_count, 0) AS bundled_count, coalesce(bundled_text_count, 0) AS bundled_text_count, CAST(coalesce(len(bundled_files), 0) AS INT) AS files,
  CAST(coalesce(list_sum(list_transform(bundled_files, lambda f: coalesce(f.size, 0))), 0) AS BIGINT) AS bytes, coalesce(array_to_string(list_transform(bundled_files, lambda f: coalesce(f.path, '')), '|'), '') AS paths,
  CAST(coalesce(len(list_filter(bundled_files, lambda f: coalesce(f.binary_or_oversize, false))), 0) AS INT) AS binary FROM bundled WHERE repo IS NOT NULL AND skill_path IS NOT NULL""",
        "optional_columns": "SELECT pair_id, skill_id, repo, intent_text, commit_subject, platform, pr_number, round(quality_score::double, 4) AS quality_score, license_spdx, stars FROM (SELECT DISTINCT * FROM curator_training)",
        "eval_candidates_first": f"WITH {REV}, {KIND} SELECT pair_id, k AS intent_class, CAST({_B} AS INT) AS b, CAST({_A} AS INT) AS a FROM kind WHERE {_B} >= 200 AND {_A} >= 200 AND abs({_A} - {_B}) <= 20000 AND length({_INTENT}) >= 12 AND {_A} >= 0.3 * {_B}",
        "rules_found": rf"""WITH p AS (SELECT DISTINCT skill_path AS p FROM diffs WHERE skill_path IS NOT NULL), x AS (SELECT DISTINCT unnest([p, p || '.mdc', '.cursor/rules/' || p, p || '/.cursorrules-x.txt', p || '/.cursorrules']) AS path FROM p)
SELECT path, starts_with(lower({_BASE}), '.cursorrules') OR (contains(lower(path), '.cursor/rules/') AND regexp_matches(lower(path), '\.(mdc|md)$')) OR lower(path) LIKE '%.mdc' AS found,
  CASE WHEN lower({_BASE}) = '.cursorrules' THEN 'cursorrules-root' WHEN starts_with(lower({_BASE}), '.cursorrules') THEN ltrim({_STEM}, '.') ELSE {_STEM} END AS name FROM x""",
        "card_examples": _card_sql(),
        "platform_guard": "SELECT platform, platform IN (SELECT platform FROM diffs WHERE platform IS NOT NULL) AS present FROM (SELECT unnest(['claude_skill', 'opencode_skill', 'hermes_skill', 'openclaw_skill', 'cursor_rule', 'new_rule']) AS platform)",
        "cluster_map_defaults": f"""WITH {REV}, one AS (SELECT skill_id, max(skill_cluster_id) AS c FROM curator_training WHERE coalesce(skill_cluster_id, '') <> '' AND skill_id IS NOT NULL GROUP BY 1),
m AS (SELECT skill_id, c, skill_id = min(skill_id) OVER (PARTITION BY c) AS first FROM one)
SELECT pair_id, coalesce(c, '') AS near, coalesce(first, true) AS near_canonical, c AS semantic, first AS semantic_canonical FROM rev LEFT JOIN m USING (skill_id)""",
        "pending_variants": f"""WITH j AS ({_LATEST}), done AS (SELECT user_id FROM j WHERE status IN ('click', 'view')) SELECT 'retry' AS variant, c_custkey AS user_id FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM done)
  UNION ALL SELECT 'untried', c_custkey FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM j) UNION ALL SELECT 'no_failed', c_custkey FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM j WHERE status IN ('click', 'view', 'purchase'))""",
        "limited_work": f"SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM ({_LATEST})) ORDER BY c_custkey LIMIT 10",
        "last_events": "SELECT event_id, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 4",
        "clean_per_shard": WITH + """SELECT replace(repo, '/', '__') AS shard, count(*) AS n_records, count(*) FILTER (NOT coalesce(is_initial, false) AND NOT list_has_any(tags, ['bot_author', 'whitespace_change', 'revert_subject',
  'pre_revert', 'merge_commit', 'duplicate_pair', 'micro_edit', 'short_skill'])) AS n_clean FROM tagged WHERE repo IS NOT NULL GROUP BY 1""",
        "known_repositories": "SELECT repo FROM repos WHERE source_seed IN ('huzey', 'expansion') AND repo IS NOT NULL UNION SELECT repo FROM curator_eval_set WHERE repo IS NOT NULL",
        "skill_paths": "SELECT repo, array_to_string(list_sort(list(DISTINCT skill_path)), '|') AS paths, CAST(count(DISTINCT skill_path) AS INT) AS n FROM diffs WHERE repo IS NOT NULL AND skill_path IS NOT NULL GROUP BY repo",
        "repository_provenance": "SELECT repo, CAST(to_json(list_sort(list({'platform': coalesce(platform, ''), 'seed': coalesce(source_seed, '')}))) AS VARCHAR) AS found FROM repos WHERE repo IS NOT NULL GROUP BY repo",
        "label_cost": f"WITH {REV}, {KIND}, c AS (SELECT count(*) AS n, CAST(ceil(count(*) / 50) AS BIGINT) AS calls FROM kind WHERE k = 'unknown') SELECT n, calls, calls * 1750 AS tokens_in, calls * 400 AS tokens_out, round(calls * 1750 / 1e6 * 1.0::double + calls * 400 / 1e6 * 5.0::double, 4) AS dollars FROM c",
        "scalar_forms": """SELECT repo, left(sha1(repo), 16) AS short_id, replace(repo, '/', '__') AS file, strftime(try_cast(pushed_at AS TIMESTAMPTZ) AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%SZ') AS pushed,
  CASE WHEN s >= 3600 THEN CAST(s // 3600 AS VARCHAR) || 'h' || lpad(CAST(s % 3600 // 60 AS VARCHAR), 2, '0') || 'm' ELSE CAST(s // 60 AS VARCHAR) || 'm' END AS took, left(sha1(repo), 12) AS sha, '' AS none
  FROM (SELECT DISTINCT repo, pushed_at, CAST(coalesce(stars, 0) AS BIGINT) * 37 + 59 AS s FROM repos WHERE repo IS NOT NULL)""",
        "sample_row": f"""WITH {REV}, {KIND} SELECT pair_id, k AS intent_class, CASE WHEN length(commit_subject) > 80 THEN left(commit_subject, 80) || '...' ELSE commit_subject END AS subject,
  CASE WHEN length(after_content) > 80 THEN left(after_content, 80) || '...' ELSE after_content END AS text FROM kind WHERE {_evaluable_sql()} ORDER BY pair_id LIMIT 1""",
        "labelled": f"""WITH {REV}, {KIND}, l AS (SELECT *, k = 'unknown' AND s <> '' AND NOT contains(s, chr(10)) AS asked, length(s) % 3 AS m FROM kind)
SELECT CASE WHEN asked THEN CASE m WHEN 0 THEN 'docs' WHEN 1 THEN 'fix' ELSE 'other' END ELSE k END AS intent_class, CAST(CASE WHEN asked THEN 0.85 ELSE conf END AS DOUBLE) AS confidence, count(*) AS n FROM l GROUP BY 1, 2""",
    }


SQL = sql()
