"""Queries over revisions: identity, intent, tags, subsets, scores; each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from palimpsest.functions.intent import CONVENTIONAL, INFORMAL
from palimpsest.functions.structure import diff_summary, parse_skill
from palimpsest.functions.tags import BOTS, INJECTIONS, MAIL, NOBODY, NOT_CLEAN, NOT_CURATED, NOT_STRICT, PLACEHOLDERS, any_of, pii_email
from palimpsest.functions.text import body, code_blocks, content_hash, headings, pair_hash, share, stable_id, text_of, valid_frontmatter
from palimpsest.operators.chain import before_revert, first_per_key, seen_before, with_previous
from palimpsest.operators.subset import GENERIC, clean, curated, evaluable, has_none, intent_text, stratified
from palimpsest.plans.revisions import CHAIN, ORDER, consolidated, identity_facts, revisions, same_author, tagged, with_intent

joined = lambda c: F.array_join(c, ",")
_q = lambda s: s.replace("'", "''")

REV = """rev AS (SELECT * EXCLUDE rn, try_cast(commit_date AS TIMESTAMPTZ) AS ts FROM (SELECT *, row_number() OVER (PARTITION BY pair_id
  ORDER BY (pr_number IS NOT NULL)::int + (coalesce(skill_cluster_id, '') <> '')::int + (is_canonical IS NOT NULL)::int DESC) AS rn
  FROM diffs WHERE pair_id IS NOT NULL) WHERE rn = 1)"""
_SAID = (
    f"CASE WHEN regexp_extract(s, '{CONVENTIONAL}', 1) <> '' THEN lower(regexp_extract(s, '{CONVENTIONAL}', 1)) "
    + " ".join(f"WHEN regexp_matches(s, '(?i){p}') THEN '{k}'" for p, k in INFORMAL)
    + " ELSE 'unknown' END"
)
_HOW = (
    f"CASE WHEN regexp_extract(s, '{CONVENTIONAL}', 1) <> '' THEN 0.95 WHEN " + " OR ".join(f"regexp_matches(s, '(?i){p}')" for p, _ in INFORMAL) + " THEN 0.65 ELSE 0.0 END"
)
KIND = f"""said AS (SELECT *, {_SAID} AS said, {_HOW} AS how FROM (SELECT *, coalesce(commit_subject, '') AS s, coalesce(lines_added, 0) AS a,
  coalesce(lines_removed, 0) AS r, abs(coalesce(char_delta, 0)) AS dl FROM rev)),
kind AS (SELECT *, CASE WHEN first THEN 'initial' WHEN a = 0 AND r = 0 OR a <= 1 AND r <= 1 AND dl < 30 AND said = 'unknown' THEN 'whitespace' ELSE said END AS k,
  CASE WHEN first THEN 0.95 WHEN a = 0 AND r = 0 THEN 0.9 WHEN a <= 1 AND r <= 1 AND dl < 30 AND said = 'unknown' THEN 0.6 ELSE how END AS conf
  FROM (SELECT *, coalesce(is_initial, false) AND r = 0 AND (s = '' OR contains(lower(s), 'init') OR contains(lower(s), 'first')) AS first FROM said))"""
_or = lambda col, ps: "(" + " OR ".join(f"coalesce(regexp_matches({col}, '{_q(p)}'), false)" for p in ps) + ")"
_STRIP = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"
FLAGS = """flags AS (SELECT *, after_n > 1 AS duplicate_after, pair_n > 1 AS duplicate_pair,
  starts_with(lower(ltrim(coalesce(nxt, ''))), 'revert') AS pre_revert FROM (SELECT *,
  row_number() OVER (PARTITION BY fam, sha256(coalesce(after_content, '')) ORDER BY ts NULLS FIRST, pair_id) AS after_n,
  row_number() OVER (PARTITION BY fam, sha256(coalesce(before_content, '') || chr(0) || chr(1) || chr(2) || coalesce(after_content, '')) ORDER BY ts NULLS FIRST, pair_id) AS pair_n,
  lead(commit_subject) OVER (PARTITION BY repo, skill_path ORDER BY ts NULLS FIRST, pair_id) AS nxt
  FROM (SELECT *, CASE WHEN platform = 'cursor_rule' THEN 'cursor' ELSE 'skill' END AS fam FROM kind)))"""
_small = "(a <= 2 AND r <= 2 AND dl < 40)"
_tags = {
    "bot_author": _or("commit_email", BOTS), "whitespace_change": "k = 'whitespace'", "merge_commit": "k = 'merge'",
    "revert_subject": "starts_with(lower(trim(s)), 'revert')", "initial_commit": "is_initial", "short_skill": "length(coalesce(after_content, '')) < 500 AND NOT coalesce(is_initial, false)",
    "large_blob": "length(coalesce(before_content, '')) > 200000 OR length(coalesce(after_content, '')) > 200000",
    "non_utf8_clean": "contains(coalesce(after_content, ''), chr(65533)) OR contains(coalesce(before_content, ''), chr(65533))",
    "micro_edit": f"NOT coalesce(is_initial, false) AND {_small}", "duplicate_after": "duplicate_after", "duplicate_pair": "duplicate_pair", "pre_revert": "pre_revert",
}
_list = lambda tags: "list_sort(list_filter([" + ", ".join(f"CASE WHEN {w} THEN '{t}' END" for t, w in tags.items()) + "], lambda x: x IS NOT NULL))"
TAGGED = f"tagged AS (SELECT *, {_list(_tags)} AS tags FROM flags)"
WITH = f"WITH {REV}, {KIND}, {FLAGS}, {TAGGED} "
_none = lambda names, col="tags": f"NOT list_has_any({col}, [{', '.join(repr(n) for n in names)}])"
_FM = r"(?s)\A---\s*\r?\n(.*?)\r?\n---\s*\r?\n"
_VALID = rf"(regexp_matches(after_content, '{_FM}') AND regexp_matches(regexp_extract(after_content, '{_FM}', 1), '(?m)^name\s*:\s*\S+') AND regexp_matches(regexp_extract(after_content, '{_FM}', 1), '(?m)^description\s*:\s*\S'))"
_PII = (
    f"len(list_filter(regexp_extract_all(coalesce(after_content, ''), '{MAIL}'), lambda m: NOT (split_part(lower(m), '@', 2) IN ({', '.join(repr(n) for n in NOBODY)})"
    r" OR regexp_matches(split_part(lower(m), '@', 2), '\.(example|local|test)$') OR contains(split_part(lower(m), '@', 2), 'noreply')))) > 0"
)
REPOS = """rp AS (SELECT repo, license_spdx, stars, pushed_at, true AS known FROM (SELECT *, row_number() OVER (PARTITION BY repo ORDER BY
  (coalesce(license_spdx, '') <> '')::int + (coalesce(license_name, '') <> '')::int + (stars IS NOT NULL)::int + (coalesce(default_branch, '') <> '')::int + (coalesce(pushed_at, '') <> '')::int
  + (coalesce(fetched_at, '') <> '')::int + (coalesce(fetch_status, '') <> '')::int DESC) AS rn FROM repos WHERE repo IS NOT NULL) WHERE rn = 1)"""
_extra = {
    "invalid_frontmatter": f"NOT coalesce({_VALID}, false)", "placeholder_content": _or("after_content", PLACEHOLDERS), "pii_email": _PII,
    "prompt_injection_pattern": _or("after_content", INJECTIONS), "no_license": "coalesce(known, false) AND coalesce(license_spdx, '') = ''",
    "low_engagement": "coalesce(known, false) AND coalesce(license_spdx, '') = '' AND coalesce(stars, 0) = 0 AND NOT coalesce(try_cast(pushed_at AS TIMESTAMPTZ) >= TIMESTAMPTZ '2023-06-01 00:00:00+00', false)",
    "same_author_dup": "author_n > 1 AND coalesce(commit_email, '') <> '' AND coalesce(after_content, '') <> ''",
}
ALL = f"""{REPOS}, alltags AS (SELECT *, list_sort(list_distinct(list_concat(tags, {_list(_extra)}))) AS every FROM (SELECT t.*, rp.license_spdx, rp.stars, rp.pushed_at, rp.known,
  row_number() OVER (PARTITION BY commit_email, after_content ORDER BY ts NULLS FIRST, t.pair_id) AS author_n FROM tagged t LEFT JOIN rp USING (repo)))"""
_has = lambda names: _none(names, "every")
SCORED = f"""scored AS (SELECT *, least(1.0, (coalesce(license_spdx, '') <> '')::int * 0.20 + (coalesce(stars, 0) >= 10)::int * 0.10 + (coalesce(stars, 0) >= 100)::int * 0.10 + (coalesce(pr_title, '') <> '')::int * 0.15
  + ({_has(NOT_CURATED)})::int * 0.20 + ({_has(NOT_STRICT)})::int * 0.10 + (k IN ('feat', 'fix', 'refactor', 'docs'))::int * 0.05 + (length(coalesce(after_content, '')) BETWEEN 500 AND 30000)::int * 0.10) AS score FROM alltags)"""
EVERY = WITH + f", {ALL}, {SCORED} "
_INTENT = "coalesce(nullif(" + _STRIP.format("coalesce(pr_title, '')") + ", ''), " + _STRIP.format("coalesce(commit_subject, '')") + ")"
_CURATED = f"""curated AS (SELECT * FROM (SELECT *, {_INTENT} AS intent_text FROM scored) WHERE NOT coalesce(is_initial, false) AND coalesce(is_canonical, false)
  AND k NOT IN ('whitespace', 'merge', 'micro') AND length(intent_text) >= 8 AND lower(intent_text) NOT IN ({', '.join(repr(g) for g in GENERIC)}))"""
_SIZES = "length(coalesce(before_content, ''))", "length(coalesce(after_content, ''))"
_EVAL = f"{_SIZES[0]} >= 200 AND {_SIZES[1]} >= 200 AND {_SIZES[1]} <= 30000 AND length({_INTENT}) >= 12 AND {_SIZES[1]}::double / {_SIZES[0]} BETWEEN 0.3 AND 3.0"


def stable_ids(spark, d):
    df = revisions(spark, d, ["repo", "skill_path", "before_sha", "after_sha"])
    c = F.col
    return df.select("pair_id", stable_id(c("repo"), c("skill_path")).alias("skill_key"), stable_id(c("repo"), c("skill_path"), c("before_sha"), c("after_sha")).alias("pair_key"))


def content_and_pair_hash(spark, d):
    b, a = F.col("before_content"), F.col("after_content")
    author = F.sha1(F.concat("commit_email", F.lit("\x00"), "after_content"))
    return revisions(spark, d, [], {"after_hash": content_hash(a), "pair_hash": pair_hash(b, a), "author_hash": author})


_INTENT_COLS = ["commit_subject", "is_initial", "lines_added", "lines_removed", "char_delta"]


def intent_records(spark, d):
    df = with_intent(revisions(spark, d, _INTENT_COLS))
    return df.select("pair_id", "intent_class", F.round(F.col("intent_confidence").cast("double"), 2).alias("intent_confidence"))


def intent_classes(spark, d):
    return with_intent(revisions(spark, d, _INTENT_COLS)).groupBy("intent_class").agg(F.count("*").alias("n"))


def quality_tags_base(spark, d):
    return tagged(spark, d).select("pair_id", joined("quality_tags").alias("tags"))


def tag_counts(spark, d):
    df = tagged(spark, d).select(F.explode("quality_tags").alias("tag"), "pair_id")
    return df.groupBy("tag").agg(F.count("*").alias("n"))


def clean_subset(spark, d):
    return clean(tagged(spark, d)).select("pair_id", "repo", "intent_class")


def clean_with_initial(spark, d):
    return clean(tagged(spark, d), include_initial=True).groupBy("is_initial").agg(F.count("*").alias("n"))


def initial_subset(spark, d):
    return revisions(spark, d, ["repo", "is_initial"]).where("is_initial").select("pair_id", "repo")


def repo_rollup(spark, d):
    df = tagged(spark, d)
    first = F.coalesce("is_initial", F.lit(False))
    ok = ~first & has_none(F.col("quality_tags"), NOT_CLEAN)
    return df.groupBy("repo", "platform").agg(
        F.countDistinct("skill_path").alias("n_skills"), F.count("*").alias("n_records"), F.count_if(~first).alias("n_diff_pairs"), F.count_if(ok).alias("n_clean")
    )


def corpus_stats(spark, d):
    df = revisions(spark, d, ["repo", "skill_id"], {"h": content_hash(F.col("after_content"))})
    texts = F.countDistinct("h")
    return df.agg(
        F.count("*").alias("records"), F.countDistinct("repo").alias("repos"), F.countDistinct("skill_id").alias("skills"), texts.alias("texts"),
        F.round(share(F.count("h") - texts, F.count("h")), 4).alias("repeated_percent"),
    )


def _bucket(c, limits):
    out = None
    for top, name in limits:
        out = (F if out is None else out).when(c <= top, name)
    return out


def lines_histogram(spark, d):
    df = revisions(spark, d, ["lines_added"])
    c = F.coalesce("lines_added", F.lit(0))
    return df.groupBy(_bucket(c, [(0, "0"), (5, "1-5"), (20, "6-20"), (100, "21-100")]).otherwise("101+").alias("bucket")).agg(F.count("*").alias("n"))


def chain_length_histogram(spark, d):
    df = revisions(spark, d, ["skill_id"]).groupBy("skill_id").count()
    return df.groupBy(_bucket(F.col("count"), [(1, "1"), (3, "2-3"), (5, "4-5"), (10, "6-10")]).otherwise("11+").alias("bucket")).agg(F.count("*").alias("n"))


def before_after_pairs(spark, d):
    """The previous text of the chain (as its hash), and what the text grew by."""
    df = revisions(spark, d, [*CHAIN, "commit_date"], {"now": F.struct(F.sha2("after_content", 256).alias("h"), F.length("after_content").alias("n"))})
    out = with_previous(df.withColumn("now", F.when(F.col("now.h").isNotNull(), F.col("now"))), CHAIN, ORDER, "now", "before")
    grown = F.coalesce("now.n", F.lit(0)) - F.coalesce("before.n", F.lit(0))
    return out.select("pair_id", F.col("before.h").alias("previous"), "is_first", grown.alias("char_delta"))


def pre_revert(spark, d):
    df = revisions(spark, d, [*CHAIN, "commit_subject", "commit_date"])
    return before_revert(df, CHAIN, ORDER, "commit_subject").where("pre_revert").select("pair_id")


def duplicate_after(spark, d):
    return tagged(spark, d).where("duplicate_after").select("pair_id", "family")


def duplicate_pair(spark, d):
    return tagged(spark, d).where("duplicate_pair").select("pair_id", "family")


def same_author_dup(spark, d):
    df = revisions(spark, d, ["commit_date"], identity_facts())
    return same_author(df).where("same_author_dup").select("pair_id")


def frontmatter_valid(spark, d):
    return revisions(spark, d, [], {"valid": valid_frontmatter(F.col("after_content"))})


def headings_and_fences(spark, d):
    b = body(F.col("after_content"))
    return revisions(spark, d, [], {"headings": F.array_join(headings(b), "|"), "code_blocks": code_blocks(b)}).where("code_blocks is not null")


def _summaries(spark, d):
    b, a = F.col("before_content"), F.col("after_content")
    return revisions(spark, d, [], {"s": diff_summary(b, a, parse_skill(b), parse_skill(a))})


def diff_summaries(spark, d):
    s = "s."
    cols = ("frontmatter_changed", "frontmatter_name_changed", "body_added_chars", "body_removed_chars", "code_blocks_before", "code_blocks_after", "edit_kind")
    return _summaries(spark, d).select("pair_id", *[s + c for c in cols], F.array_join("s.sections_added", "|").alias("sections_added"), F.array_join("s.sections_removed", "|").alias("sections_removed"))


def edit_kind_counts(spark, d):
    return _summaries(spark, d).groupBy(F.col("s.edit_kind").alias("edit_kind")).agg(F.count("*").alias("n"))


def placeholder_pii(spark, d):
    a = F.col("after_content")
    return revisions(spark, d, [], {"placeholder": any_of(a, PLACEHOLDERS), "pii": pii_email(a)})


def injection_tag(spark, d):
    return revisions(spark, d, [], {"injection": any_of(F.col("after_content"), INJECTIONS)})


def all_tags(spark, d):
    return consolidated(spark, d).select("pair_id", joined("quality_tags").alias("tags"))


def quality_scores(spark, d):
    return consolidated(spark, d).select("pair_id", F.round(F.col("quality_score").cast("double"), 4).alias("score"))


def score_histogram(spark, d):
    s = F.round(F.col("quality_score").cast("double"), 4)
    b = F.when(s < 0.3, "0.0").when(s < 0.5, "0.3").when(s < 0.7, "0.5").when(s < 0.85, "0.7").otherwise("0.85")
    return consolidated(spark, d).groupBy(b.alias("bucket")).agg(F.count("*").alias("n"))


def curator_subset(spark, d):
    return curated(consolidated(spark, d)).select("pair_id", "repo", "intent_text")


def curator_strict(spark, d):
    return curated(consolidated(spark, d), strict=True).select("pair_id", "repo", "intent_text")


def _evaluable(spark, d):
    df = with_intent(revisions(spark, d, [*_INTENT_COLS, "before_content", "after_content", "pr_title"]))
    said = intent_text(F.col("pr_title"), F.col("commit_subject"))
    return df.where(evaluable(F.col("before_content"), F.col("after_content"), said))


def eval_candidates(spark, d):
    return _evaluable(spark, d).select("pair_id", "intent_class")


def stratified_sample(spark, d):
    return stratified(_evaluable(spark, d).select("pair_id", "intent_class"), "pair_id", "intent_class", 20, 42)


def chat_format(spark, d):
    df = _evaluable(spark, d).withColumn("said", intent_text(F.col("pr_title"), F.col("commit_subject")))
    turn = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    ask = F.concat(F.lit("Intent: "), "said", F.lit("\n\n"), "before_content")
    turns = F.array(turn("system", F.lit("Apply the intent to the skill.")), turn("user", ask), turn("assistant", F.col("after_content")))
    return df.select("pair_id", F.sha2(F.to_json(turns), 256).alias("digest"), F.size(turns).alias("turns"), F.length(ask).alias("asked"))


def first_per_skill(spark, d):
    df = revisions(spark, d, ["skill_id", "commit_date"])
    return first_per_key(df.select("skill_id", "pair_id", "ts"), ["skill_id"], ORDER).select("skill_id", "pair_id")


def incremental_dedup(spark, d):
    """A platform's texts against those already held."""
    df = revisions(spark, d, ["platform", "commit_date"], {"h": content_hash(text_of("after_content"))}).select("pair_id", "platform", "ts", "h")
    held, new = df.where("platform in ('claude_skill', 'opencode_skill')"), df.where("platform not in ('claude_skill', 'opencode_skill')")
    from palimpsest.operators.chain import new_content

    return new_content(new, held, "h", ORDER).select("pair_id", "platform")


QUERIES = {
    f.__name__: f
    for f in (
        stable_ids, content_and_pair_hash, intent_records, intent_classes, quality_tags_base, tag_counts, clean_subset, clean_with_initial, initial_subset, repo_rollup, corpus_stats, lines_histogram,
        chain_length_histogram, before_after_pairs, pre_revert, duplicate_after, duplicate_pair, same_author_dup, frontmatter_valid, headings_and_fences, edit_kind_counts, placeholder_pii,
        injection_tag, all_tags, quality_scores, score_histogram, curator_subset, curator_strict, eval_candidates, stratified_sample, chat_format, first_per_skill, incremental_dedup,
    )
} | {"diff_summary": diff_summaries}

_id = lambda *c: "left(sha1(" + " || ".join(f"coalesce({x}, '') || chr(0)" for x in c) + "), 16)"
_hist = lambda col, lim, last: "CASE " + " ".join(f"WHEN {col} <= {t} THEN '{n}'" for t, n in lim) + f" ELSE '{last}' END"
_BODY = rf"regexp_replace(after_content, '{_FM}', '')"
SQL = {
    "stable_ids": f"WITH {REV} SELECT pair_id, {_id('repo', 'skill_path')} AS skill_key, {_id('repo', 'skill_path', 'before_sha', 'after_sha')} AS pair_key FROM rev",
    "content_and_pair_hash": f"WITH {REV} SELECT pair_id, sha256(after_content) AS after_hash, sha256(coalesce(before_content, '') || chr(0) || chr(1) || chr(2) || coalesce(after_content, '')) AS pair_hash, sha1(commit_email || chr(0) || after_content) AS author_hash FROM rev",
    "intent_records": f"WITH {REV}, {KIND} SELECT pair_id, k AS intent_class, CAST(conf AS DOUBLE) AS intent_confidence FROM kind",
    "intent_classes": f"WITH {REV}, {KIND} SELECT k AS intent_class, count(*) AS n FROM kind GROUP BY k",
    "quality_tags_base": WITH + "SELECT pair_id, array_to_string(tags, ',') AS tags FROM tagged",
    "tag_counts": WITH + "SELECT tag, count(*) AS n FROM (SELECT unnest(tags) AS tag FROM tagged) GROUP BY tag",
    "clean_subset": WITH + f"SELECT pair_id, repo, k AS intent_class FROM tagged WHERE NOT coalesce(is_initial, false) AND {_none(NOT_CLEAN)}",
    "clean_with_initial": WITH + f"SELECT is_initial, count(*) AS n FROM tagged WHERE {_none(NOT_CLEAN)} GROUP BY is_initial",
    "initial_subset": f"WITH {REV} SELECT pair_id, repo FROM rev WHERE is_initial",
    "repo_rollup": WITH + f"SELECT repo, platform, count(DISTINCT skill_path) AS n_skills, count(*) AS n_records, count(*) FILTER (NOT coalesce(is_initial, false)) AS n_diff_pairs, count(*) FILTER (NOT coalesce(is_initial, false) AND {_none(NOT_CLEAN)}) AS n_clean FROM tagged GROUP BY repo, platform",
    "corpus_stats": f"WITH {REV} SELECT count(*) AS records, count(DISTINCT repo) AS repos, count(DISTINCT skill_id) AS skills, count(DISTINCT after_content) AS texts, round(100.0 * (1 - count(DISTINCT after_content)::double / greatest(count(after_content), 1)), 4) AS repeated_percent FROM rev",
    "lines_histogram": f"WITH {REV} SELECT {_hist('coalesce(lines_added, 0)', [(0, '0'), (5, '1-5'), (20, '6-20'), (100, '21-100')], '101+')} AS bucket, count(*) AS n FROM rev GROUP BY 1",
    "chain_length_histogram": f"WITH {REV} SELECT {_hist('c', [(1, '1'), (3, '2-3'), (5, '4-5'), (10, '6-10')], '11+')} AS bucket, count(*) AS n FROM (SELECT count(*) AS c FROM rev GROUP BY skill_id) GROUP BY 1",
    "before_after_pairs": f"WITH {REV} SELECT pair_id, sha256(previous) AS previous, previous IS NULL AS is_first, CAST(coalesce(length(after_content), 0) - coalesce(length(previous), 0) AS INT) AS char_delta FROM (SELECT pair_id, after_content, last_value(after_content IGNORE NULLS) OVER (PARTITION BY repo, skill_path ORDER BY ts NULLS FIRST, pair_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous FROM rev)",
    "pre_revert": WITH + "SELECT pair_id FROM tagged WHERE pre_revert",
    "duplicate_after": WITH + "SELECT pair_id, fam AS family FROM tagged WHERE duplicate_after",
    "duplicate_pair": WITH + "SELECT pair_id, fam AS family FROM tagged WHERE duplicate_pair",
    "same_author_dup": f"WITH {REV} SELECT pair_id FROM (SELECT pair_id, row_number() OVER (PARTITION BY commit_email, after_content ORDER BY ts NULLS FIRST, pair_id) AS n FROM rev WHERE coalesce(commit_email, '') <> '' AND coalesce(after_content, '') <> '') WHERE n > 1",
    "frontmatter_valid": f"WITH {REV} SELECT pair_id, coalesce({_VALID}, false) AS valid FROM rev",
    "headings_and_fences": rf"WITH {REV} SELECT pair_id, array_to_string(list_transform(regexp_extract_all({_BODY}, '(?m)^(#{{1,2}})\s+(.+?)\s*$', 2), lambda x: {_STRIP.format('x')}), '|') AS headings, CAST(len(regexp_extract_all({_BODY}, '(?m)^```')) // 2 AS INT) AS code_blocks FROM rev WHERE after_content IS NOT NULL",
    "placeholder_pii": f"WITH {REV} SELECT pair_id, {_or('after_content', PLACEHOLDERS)} AS placeholder, {_PII} AS pii FROM rev",
    "injection_tag": f"WITH {REV} SELECT pair_id, {_or('after_content', INJECTIONS)} AS injection FROM rev",
    "all_tags": EVERY + "SELECT pair_id, array_to_string(every, ',') AS tags FROM scored",
    "quality_scores": EVERY + "SELECT pair_id, round(score::double, 4) AS score FROM scored",
    "score_histogram": EVERY + "SELECT CASE WHEN s < 0.3 THEN '0.0' WHEN s < 0.5 THEN '0.3' WHEN s < 0.7 THEN '0.5' WHEN s < 0.85 THEN '0.7' ELSE '0.85' END AS bucket, count(*) AS n FROM (SELECT round(score::double, 4) AS s FROM scored) GROUP BY 1",
    "curator_subset": EVERY + f", {_CURATED} SELECT pair_id, repo, intent_text FROM curated WHERE {_has(NOT_CURATED)}",
    "curator_strict": EVERY + f", {_CURATED} SELECT pair_id, repo, intent_text FROM curated WHERE {_has((*NOT_CURATED, *NOT_STRICT))}",
    "eval_candidates": f"WITH {REV}, {KIND} SELECT pair_id, k AS intent_class FROM kind WHERE {_EVAL}",
    "stratified_sample": f"WITH {REV}, {KIND} SELECT pair_id, intent_class FROM (SELECT pair_id, k AS intent_class, row_number() OVER (PARTITION BY k ORDER BY sha1(pair_id || ':42')) AS n FROM kind WHERE {_EVAL}) WHERE n <= 20",
    "chat_format": f"""WITH {REV}, {KIND}, ev AS (SELECT *, 'Intent: ' || {_INTENT} || chr(10) || chr(10) || before_content AS ask FROM kind WHERE {_EVAL})
  SELECT pair_id, sha256(CAST(to_json([{{'role': 'system', 'content': 'Apply the intent to the skill.'}}, {{'role': 'user', 'content': ask}}, {{'role': 'assistant', 'content': after_content}}]) AS VARCHAR)) AS digest,
  3 AS turns, CAST(length(ask) AS INT) AS asked FROM ev""",
    "first_per_skill": f"WITH {REV} SELECT skill_id, pair_id FROM (SELECT skill_id, pair_id, row_number() OVER (PARTITION BY skill_id ORDER BY ts NULLS FIRST, pair_id) AS n FROM rev) WHERE n = 1",
    "incremental_dedup": f"WITH {REV}, t AS (SELECT pair_id, platform, ts, sha256(coalesce(after_content, '')) AS h, platform IN ('claude_skill', 'opencode_skill') AS held FROM rev WHERE platform IS NOT NULL) SELECT pair_id, platform FROM (SELECT *, row_number() OVER (PARTITION BY h ORDER BY ts NULLS FIRST, pair_id) AS n FROM t WHERE NOT held AND h NOT IN (SELECT h FROM t WHERE held)) WHERE n = 1",
}
