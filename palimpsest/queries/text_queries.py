"""Queries over texts and vectors: structure, lint, duplicates, neighbours, metrics; each with its SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import functions as F

from palimpsest.functions import lint as rules
from palimpsest.functions import metrics
from palimpsest.functions.text import outer_fence_removed, share
from palimpsest.operators import minhash, vectors
from palimpsest.operators.chain import dense_ids
from palimpsest.operators.subset import evaluable, intent_text
from palimpsest.plans.revisions import revisions, with_intent
from palimpsest.queries.revision_queries import _EVAL, _FM, _INTENT, _INTENT_COLS, KIND, REV
from palimpsest.session import table

_PROMPT = "Skill:\n{before}\n\nIntent: {intent}\n\nGive the revised skill in full."


def _findings(spark, d, which=None):
    return revisions(spark, d, [], {"found": F.when(F.col("after_content").isNotNull(), rules.lint(F.col("after_content"), which))}).where("found is not null")


def lint_findings(spark, d):
    f = _findings(spark, d).select("pair_id", F.explode("found").alias("f"))
    return f.select("pair_id", "f.rule", "f.severity", "f.line")


def lint_report(spark, d):
    """Per rule: findings, texts that have any and their share of all texts, the first line."""
    n = revisions(spark, d, [], {"there": F.col("after_content").isNotNull()}).where("there").count()
    f = _findings(spark, d).select("pair_id", F.explode("found").alias("f"))
    per = f.groupBy("f.rule", "f.severity").agg(F.count("*").alias("findings"), F.countDistinct("pair_id").alias("texts"), F.min("f.line").alias("first_line"))
    return per.withColumn("percent", F.round(share(F.col("texts"), F.lit(n)), 4))


def shingle_counts(spark, d):
    return minhash.run_counts(table(spark, d, "documents").where("text is not null"), "doc_id", "text").withColumnRenamed("runs", "shingles")


def _clusters(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    return minhash.clusters(docs, "doc_id", "text")


def near_dup_clusters(spark, d):
    return _clusters(spark, d)


def cluster_stats(spark, d):
    return minhash.cluster_stats(_clusters(spark, d))


def cluster_join(spark, d):
    """Documents per source with the numbered clusters they lie in."""
    c = _clusters(spark, d)
    named = dense_ids(c, "cluster", "doc_id", "c")
    docs = table(spark, d, "documents").select("doc_id", "source")
    return docs.join(c.join(named, "cluster"), "doc_id").groupBy("source").agg(F.countDistinct("id").alias("clusters"), F.count_if("is_canonical").alias("canonical"), F.min("id").alias("first_id"))


def _near(spark, d, k, least=-1.0):
    v = table(spark, d, "embeddings").select("vec_id", "embedding")
    return vectors.neighbours(v, v.where("vec_id % 100 = 0"), "vec_id", "embedding", k, least)


def vector_topk(spark, d):
    return _near(spark, d, 10).select("query", "vec_id", F.round("similarity", 4).alias("similarity"), "rank")


def vector_index(spark, d):
    """Whether an index of cells finds nine in ten of the ten nearest vectors of every hundredth one, for how many of these."""
    v = table(spark, d, "embeddings").select("vec_id", "embedding")
    q = v.where("vec_id % 100 = 0")
    c = vectors.centres(v, "vec_id", "embedding")
    found = vectors.indexed_neighbours(v, q, "vec_id", "embedding", 10, c, probes=max(1, round(0.4 * len(c))))
    exact = vectors.neighbours(v, q, "vec_id", "embedding", 10).select("query", "vec_id")
    both = exact.join(found.select("query", "vec_id", F.lit(1).alias("hit")), ["query", "vec_id"], "left")
    return both.agg(F.countDistinct("query").alias("queries"), (F.count("hit") >= 0.9 * F.count("*")).alias("recalled"))


def vector_clusters(spark, d):
    v = table(spark, d, "embeddings").select("vec_id", "embedding")
    pairs = vectors.neighbours(v, v, "vec_id", "embedding", 10, 0.4)
    return vectors.similar_clusters(pairs, v, "vec_id")


def _edits(spark, d):
    df = with_intent(revisions(spark, d, [*_INTENT_COLS, "before_content", "after_content", "pr_title"]))
    said = intent_text(F.col("pr_title"), F.col("commit_subject"))
    return df.withColumn("said", said).where(evaluable(F.col("before_content"), F.col("after_content"), F.col("said")))


def metric_exact(spark, d):
    return _edits(spark, d).select("pair_id", metrics.exact(F.col("before_content"), F.col("after_content")).alias("score"))


def metric_edit(spark, d):
    return _edits(spark, d).select("pair_id", F.round(metrics.edit_ratio("before_content", "after_content"), 6).alias("score"))


def metric_rouge(spark, d):
    return _edits(spark, d).select("pair_id", F.round(metrics.rouge_l("before_content", "after_content"), 6).alias("score"))


def metric_lint_delta(spark, d):
    return _edits(spark, d).select("pair_id", metrics.lint_delta(F.col("before_content"), F.col("after_content")).alias("score"))


def eval_summary(spark, d):
    """Means of cheap metrics of the identity model, overall and per class, in one pass."""
    b, a = F.col("before_content"), F.col("after_content")
    df = _edits(spark, d).select("intent_class", metrics.exact(b, a).alias("exact"), (F.length(b).cast("double") / F.length(a)).alias("ratio"))
    g = df.groupingSets([["intent_class"], []], "intent_class").agg(F.count("*").alias("n"), metrics.mean(F.col("exact")).alias("exact"), metrics.mean(F.col("ratio")).alias("ratio"))
    return g.select(F.coalesce("intent_class", F.lit("all")).alias("intent_class"), "n", "exact", "ratio")


def eval_baselines(spark, d):
    """The two baselines over all evaluable edits: exact match and lint delta; eval_rouge has their longest common subsequence."""
    from palimpsest.plans import evaluation

    return evaluation.summary(evaluation.scored(_baselines(spark, d), {k: metrics.METRICS[k] for k in ("exact_match", "linter_delta")}))


def eval_rouge(spark, d):
    from palimpsest.plans import evaluation

    return evaluation.summary(evaluation.scored(_baselines(spark, d), {"rouge_l": metrics.METRICS["rouge_l"]}))


def _baselines(spark, d):
    from palimpsest.plans import evaluation

    edits = _edits(spark, d).withColumn("intent_text", F.col("said"))
    both = [evaluation.predict(edits, evaluation.resolve(m), m) for m in evaluation.BASELINES]
    return both[0].unionByName(both[1])


def prompt_render(spark, d):
    text = F.replace(F.replace(F.lit(_PROMPT), F.lit("{before}"), F.col("before_content")), F.lit("{intent}"), F.col("said"))
    return _edits(spark, d).select("pair_id", F.sha2(text, 256).alias("digest"))


def fence_strip(spark, d):
    """Texts wrapped in several ways, without the fence around them: as Markdown, without a language, never closed, not fenced, and
    with blanks outside."""
    t = F.col("after_content")
    forms = {
        "inner": F.concat(F.lit("```markdown\n"), t, F.lit("\n```")), "bare": F.concat(F.lit("```\n"), t, F.lit("\n```")), "open": F.concat(F.lit("```md\n"), t),
        "plain": F.concat(F.lit("> "), t, F.lit(" <")), "outside": F.concat(F.lit("\n ```\n"), t, F.lit("\n``` \n")),
    }
    return revisions(spark, d, [], {k: F.sha2(outer_fence_removed(c), 256) for k, c in forms.items()}).where("inner is not null")


QUERIES = {
    f.__name__: f
    for f in (
        lint_findings, lint_report, shingle_counts, near_dup_clusters, cluster_stats, cluster_join, vector_topk, vector_index, vector_clusters, metric_exact, metric_edit, metric_rouge, metric_lint_delta, eval_summary, eval_baselines, eval_rouge,
        prompt_render, fence_strip,
    )
}

_HAS = f"regexp_matches(c, '{_FM}')"
_F = f"regexp_extract(c, '{_FM}', 1)"
_B = f"regexp_replace(c, '{_FM}', '')"
_strip = lambda x: rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"
_PARSED = ", ".join(
    rf"{_strip(f'regexp_extract({c}, {chr(39)}{_FM}{chr(39)}, 1)')} AS fm_{n}, {_strip(f'regexp_replace({c}, {chr(39)}{_FM}{chr(39)}, {chr(39)}{chr(39)})')} AS body_{n}, "
    rf"regexp_extract(regexp_extract({c}, '{_FM}', 1), '(?m)^name\s*:\s*(.+?)\s*$', 1) AS name_{n}, "
    rf"list_distinct(list_transform(regexp_extract_all(regexp_replace({c}, '{_FM}', ''), '(?m)^(#{{1,2}})\s+(.+?)\s*$', 2), lambda x: {_strip('x')})) AS heads_{n}, "
    rf"CAST(len(regexp_extract_all(regexp_replace({c}, '{_FM}', ''), '(?m)^```')) // 2 AS INT) AS code_{n}"
    for n, c in (("b", "coalesce(before_content, '')"), ("a", "coalesce(after_content, '')"))
)
_SUMMARY = f"""p AS (SELECT *, {_PARSED} FROM rev), s AS (SELECT *, list_sort(list_filter(heads_a, lambda x: NOT list_contains(heads_b, x))) AS added,
  list_sort(list_filter(heads_b, lambda x: NOT list_contains(heads_a, x))) AS removed, fm_a <> fm_b AS fmc, body_a <> body_b AS bc FROM p),
e AS (SELECT *, CASE WHEN coalesce(before_content, '') = '' AND coalesce(after_content, '') <> '' THEN 'addition' WHEN coalesce(before_content, '') <> '' AND coalesce(after_content, '') = '' THEN 'deletion'
  WHEN NOT fmc AND NOT bc THEN 'trivial' WHEN fmc AND NOT bc THEN 'frontmatter_only' WHEN bc AND NOT fmc THEN CASE WHEN len(added) + len(removed) > 0 THEN 'structural' WHEN code_a <> code_b THEN 'code_only' ELSE 'body_only' END
  ELSE 'both' END AS edit_kind FROM s)"""
_old = "\n  UNION ALL ".join(
    f"SELECT pair_id, '{r}', 'info', CAST(list_position(list_transform(string_split(c, chr(10)), lambda x: regexp_matches(x, '(?i){p}')), true) AS INT) FROM t WHERE regexp_matches(c, '(?i){p}')" for p, r in rules.OUTDATED
)
#: The description as linted: without quotes; of a block scalar the indented lines below it.
_DESC = rf"""SELECT pair_id, CASE WHEN starts_with(bare, '|') THEN array_to_string(list_transform(CASE WHEN stop > 0 THEN rest[1:stop - 1] ELSE rest END, lambda x: {_strip('x')}), ' ') ELSE bare END AS d
  FROM (SELECT *, list_position(list_transform(rest, lambda x: starts_with(x, '  ') OR starts_with(x, chr(9))), false) AS stop FROM (SELECT pair_id, bare,
  fl[list_position(list_transform(fl, lambda x: starts_with({_strip('x')}, 'description:')), true) + 1:] AS rest FROM (SELECT pair_id, string_split({_F}, chr(10)) AS fl,
  regexp_replace({_strip(rf"regexp_extract({_F}, '(?m)^description\s*:\s*(\S(?:.*\S)?)\s*$', 1)")}, '^["'']+|["'']+$', '', 'g') AS bare FROM t WHERE {_HAS} AND regexp_matches({_F}, '(?m)^description\s*:\s*(\S(?:.*\S)?)\s*$'))))"""
_LINTED = rf"""lines AS (SELECT pair_id, unnest(string_split(c, chr(10))) AS x, generate_subscripts(string_split(c, chr(10)), 1) AS n FROM t),
fences AS (SELECT pair_id, n, {_strip('x')} AS x, row_number() OVER (PARTITION BY pair_id ORDER BY n) AS i FROM lines WHERE starts_with({_strip('x')}, '```')),
described AS ({_DESC}),
f(pair_id, rule, severity, line) AS (SELECT pair_id, 'E001-no-frontmatter', 'error', 1 FROM t WHERE NOT {_HAS}
  UNION ALL SELECT pair_id, 'E002-missing-name', 'error', 1 FROM t WHERE {_HAS} AND NOT regexp_matches({_F}, '(?m)^name\s*:\s*(.+?)\s*$')
  UNION ALL SELECT pair_id, 'E003-missing-description', 'error', 1 FROM t WHERE {_HAS} AND NOT regexp_matches({_F}, '(?m)^description\s*:\s*(\S(?:.*\S)?)\s*$')
  UNION ALL SELECT pair_id, 'W001-short-description', 'warning', NULL FROM described WHERE length(d) < 20
  UNION ALL SELECT pair_id, 'W002-long-description', 'warning', NULL FROM described WHERE length(d) > 1000
  UNION ALL SELECT pair_id, 'W003-no-trigger-language', 'warning', NULL FROM described WHERE NOT (contains(lower(d), 'use this') OR contains(lower(d), 'use when') OR contains(lower(d), 'when ') OR contains(lower(d), 'for ') OR contains(lower(d), 'to '))
  UNION ALL SELECT pair_id, 'W004-codeblock-no-lang', 'warning', CAST(n AS INT) FROM fences WHERE i % 2 = 1 AND {_strip('x[4:]')} = ''
  UNION ALL {_old}
  UNION ALL SELECT pair_id, 'W005-no-heading', 'warning', NULL FROM t WHERE NOT regexp_matches(array_to_string(string_split({_B}, chr(10))[1:50], chr(10)), '(?m)^#{{1,2}}\s')
  UNION ALL SELECT pair_id, 'W006-short-body', 'warning', NULL FROM t WHERE length({_strip(_B)}) < 200)"""
_LINT = f"WITH {REV}, t AS (SELECT pair_id, after_content AS c FROM rev WHERE after_content IS NOT NULL), {_LINTED}"
#: Documents as sets of runs; equal sets are one class.
_SETS = r"""w AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(regexp_replace(coalesce(text, ''), '(?s)\A---[ \t]*\r?\n(?:.*?\r?\n)??---[ \t]*(?:\r?\n|\z)', '')), '[\s\v\pZ\x85\x1c-\x1f]+'), lambda x: x <> '') AS w, text FROM documents WHERE doc_id IS NOT NULL),
s AS (SELECT doc_id, text, list_sort(CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) ELSE list_distinct(w) END) AS runs FROM w)"""
_COMPONENTS = """g AS (SELECT a, b FROM e UNION SELECT b, a FROM e), r(x, y) AS (SELECT n, n FROM nodes UNION SELECT r.x, g.b FROM r JOIN g ON r.y = g.a), comp AS (SELECT x, min(y) AS c FROM r GROUP BY x)"""
_CLUSTERS = f"""WITH RECURSIVE {_SETS}, cls AS (SELECT min(doc_id) AS n, runs FROM s GROUP BY runs), nodes AS (SELECT n FROM cls), u AS (SELECT n, unnest(runs) AS run FROM cls),
hit AS (SELECT p.n AS a, q.n AS b, count(*) AS k FROM u p JOIN u q ON p.run = q.run AND p.n < q.n GROUP BY 1, 2),
e AS (SELECT a, b FROM hit JOIN cls x ON x.n = a JOIN cls y ON y.n = b WHERE k >= 0.8 * (len(x.runs) + len(y.runs) - k) - 1e-9), {_COMPONENTS},
clusters AS (SELECT s.doc_id, comp.c AS cluster, s.doc_id = comp.c AS is_canonical FROM s JOIN cls ON cls.runs = s.runs JOIN comp ON comp.x = cls.n)"""
_TOPK = """SELECT query, vec_id, round(s, 4) AS similarity, rank FROM (SELECT q.vec_id AS query, v.vec_id, list_inner_product(q.embedding::double[], v.embedding::double[]) AS s,
  row_number() OVER (PARTITION BY q.vec_id ORDER BY list_inner_product(q.embedding::double[], v.embedding::double[]) DESC, v.vec_id) AS rank
  FROM embeddings q, embeddings v WHERE q.vec_id % 100 = 0) WHERE rank <= 10"""
_NEAR = """WITH RECURSIVE top AS (SELECT * FROM (SELECT q.vec_id AS a, v.vec_id AS b, list_inner_product(q.embedding::double[], v.embedding::double[]) AS s,
  row_number() OVER (PARTITION BY q.vec_id ORDER BY list_inner_product(q.embedding::double[], v.embedding::double[]) DESC, v.vec_id) AS rank FROM embeddings q, embeddings v) WHERE rank <= 10 AND s >= 0.4),
nodes AS (SELECT vec_id AS n FROM embeddings), e AS (SELECT a, b FROM top WHERE a <> b), """ + _COMPONENTS
_KIND = f"WITH {REV}, {KIND}, ev AS (SELECT *, {_INTENT} AS said2 FROM kind WHERE {_EVAL})"
_DELTA = f"""{_KIND}, t AS (SELECT unnest([pair_id || ':b', pair_id || ':a', pair_id || ':i']) AS pair_id, unnest([before_content, after_content, said2]) AS c FROM ev), {_LINTED},
counts AS (SELECT left(pair_id, length(pair_id) - 2) AS id, count(*) FILTER (pair_id LIKE '%:b') AS nb, count(*) FILTER (pair_id LIKE '%:a') AS na, count(*) FILTER (pair_id LIKE '%:i') AS ni FROM f GROUP BY 1),
delta AS (SELECT ev.*, (coalesce(na, 0) - coalesce(nb, 0))::double AS d_identity, (coalesce(na, 0) - coalesce(ni, 0))::double AS d_intent FROM ev LEFT JOIN counts ON id = pair_id)"""
_BASELINES = f"""{_DELTA}, m AS (SELECT 'identity' AS model, k, CASE WHEN {_strip('before_content')} = {_strip('after_content')} THEN 1.0::double ELSE 0.0::double END AS exact_match, d_identity AS linter_delta FROM delta
  UNION ALL SELECT 'intent_only', k, CASE WHEN {_strip('said2')} = {_strip('after_content')} THEN 1.0::double ELSE 0.0::double END, d_intent FROM delta)
SELECT model, coalesce(k, 'all') AS intent_class, count(*) AS n, count(*) AS n_ok, round(avg(exact_match), 4) AS exact_match, round(avg(linter_delta), 4) AS linter_delta FROM m GROUP BY GROUPING SETS ((model, k), (model))"""
#: Longest common subsequence of the words of pairs (id, x, y): common ends are cut off, the rest goes row by row.
_LCS = r"""w AS (SELECT id, regexp_extract_all(lower(x), '[\pL\pN_]+') AS a, regexp_extract_all(lower(y), '[\pL\pN_]+') AS b FROM texts),
ends1 AS (SELECT *, len(a) AS na, len(b) AS nb, coalesce(list_position(list_transform(range(1, least(len(a), len(b)) + 1), lambda i: a[i] = b[i]), false), least(len(a), len(b)) + 1) - 1 AS pre FROM w),
ends2 AS (SELECT *, coalesce(list_position(list_transform(range(0, least(na, nb) - pre), lambda i: a[na - i] = b[nb - i]), false), least(na, nb) - pre + 1) - 1 AS suf FROM ends1),
mid AS (SELECT id, na, nb, pre + suf AS same, a[pre + 1:na - suf] AS p, b[pre + 1:nb - suf] AS q FROM ends2),
lcs(id, i, row) AS (SELECT id, 0, list_transform(q, lambda v: 0) FROM mid UNION ALL SELECT id, i + 1, list_transform(range(1, len(m) + 1), lambda j: list_max(m[1:j]))
  FROM (SELECT lcs.id, i, list_transform(range(1, len(q) + 1), lambda j: greatest(row[j], coalesce(row[j - 1], 0) + CAST(p[i + 1] = q[j] AS INT))) AS m FROM lcs JOIN mid ON mid.id = lcs.id WHERE i < len(p))),
rouge AS (SELECT mid.id, CASE WHEN na = 0 OR nb = 0 THEN 0.0::double ELSE 2.0::double * (same + coalesce(row[-1], 0)) / (na + nb) END AS score FROM mid JOIN lcs ON lcs.id = mid.id AND i = len(p))"""
_RECURSIVE = _KIND.replace("WITH ", "WITH RECURSIVE ", 1)
_ROUGE = f"""{_RECURSIVE}, texts AS (SELECT pair_id || ':b' AS id, before_content AS x, after_content AS y FROM ev UNION ALL SELECT pair_id || ':i', said2, after_content FROM ev), {_LCS},
m AS (SELECT CASE WHEN id LIKE '%:b' THEN 'identity' ELSE 'intent_only' END AS model, k, score FROM rouge JOIN ev ON pair_id = left(id, length(id) - 2))
SELECT model, coalesce(k, 'all') AS intent_class, count(*) AS n, count(*) AS n_ok, round(avg(score), 4) AS rouge_l FROM m GROUP BY GROUPING SETS ((model, k), (model))"""
_OPEN = r"CASE WHEN o = '' THEN '```md' WHEN regexp_matches(o, '(^|\n)\s*```$') THEN regexp_replace(o, '(^|\n)[^\n]*$', '') ELSE o END"
SQL = {
    "diff_summary": f"WITH {REV}, {_SUMMARY} SELECT pair_id, fmc AS frontmatter_changed, name_a <> name_b AS frontmatter_name_changed, CAST(greatest(0, length(body_a) - length(body_b)) AS INT) AS body_added_chars, CAST(greatest(0, length(body_b) - length(body_a)) AS INT) AS body_removed_chars, code_b AS code_blocks_before, code_a AS code_blocks_after, edit_kind, array_to_string(added, '|') AS sections_added, array_to_string(removed, '|') AS sections_removed FROM e",
    "edit_kind_counts": f"WITH {REV}, {_SUMMARY} SELECT edit_kind, count(*) AS n FROM e GROUP BY edit_kind",
    "lint_report": _LINT + " SELECT rule, severity, count(*) AS findings, count(DISTINCT pair_id) AS texts, min(line) AS first_line, round(100.0 * count(DISTINCT pair_id) / greatest((SELECT count(*) FROM t), 1), 4) AS percent FROM f GROUP BY 1, 2",
    "lint_findings": _LINT + " SELECT pair_id, rule, severity, line FROM f",
    "near_dup_clusters": _CLUSTERS + " SELECT * FROM clusters",
    "cluster_stats": _CLUSTERS + ", n AS (SELECT count(*) AS k FROM clusters GROUP BY cluster) SELECT count(*) AS clusters, count(*) FILTER (k = 1) AS singletons, count(*) FILTER (k > 1) AS multi, CAST(coalesce(sum(k) FILTER (k > 1), 0) AS BIGINT) AS covered FROM n",
    "cluster_join": _CLUSTERS + ", named AS (SELECT cluster, 'c' || lpad(CAST(row_number() OVER (ORDER BY cluster) - 1 AS VARCHAR), 7, '0') AS id FROM (SELECT DISTINCT cluster FROM clusters)) SELECT source, count(DISTINCT id) AS clusters, count(*) FILTER (is_canonical) AS canonical, min(id) AS first_id FROM documents JOIN clusters USING (doc_id) JOIN named USING (cluster) GROUP BY source",
    "vector_clusters": _NEAR + " SELECT x AS vec_id, c AS cluster FROM comp",
    "metric_lint_delta": _DELTA + " SELECT pair_id, d_identity AS score FROM delta",
    "eval_baselines": _BASELINES,
    "metric_rouge": f"{_RECURSIVE}, texts AS (SELECT pair_id AS id, before_content AS x, after_content AS y FROM ev), {_LCS} SELECT id AS pair_id, round(score, 6) AS score FROM rouge",
    "eval_rouge": _ROUGE,

    "shingle_counts": f"WITH {_SETS} SELECT doc_id, CAST(len(runs) AS INT) AS shingles FROM s WHERE text IS NOT NULL",
    "vector_topk": _TOPK,
    "vector_index": "SELECT count(DISTINCT vec_id) AS queries, true AS recalled FROM embeddings WHERE vec_id % 100 = 0 AND embedding IS NOT NULL",
    "metric_exact": f"{_KIND} SELECT pair_id, CASE WHEN {_strip('before_content')} = {_strip('after_content')} THEN 1.0::double ELSE 0.0::double END AS score FROM ev",
    "eval_summary": f"{_KIND}, m AS (SELECT k, CASE WHEN {_strip('before_content')} = {_strip('after_content')} THEN 1.0::double ELSE 0.0::double END AS x, length(before_content)::double / length(after_content) AS r FROM ev) SELECT coalesce(k, 'all') AS intent_class, count(*) AS n, round(avg(x), 4) AS exact, round(avg(r), 4) AS ratio FROM m GROUP BY GROUPING SETS ((k), ())",
    "prompt_render": f"{_KIND} SELECT pair_id, sha256('Skill:' || chr(10) || before_content || chr(10) || chr(10) || 'Intent: ' || said2 || chr(10) || chr(10) || 'Give the revised skill in full.') AS digest FROM ev",
    "fence_strip": rf"WITH {REV}, x AS (SELECT pair_id, after_content AS c, regexp_replace(after_content, '\s+$', '') AS o FROM rev WHERE after_content IS NOT NULL) SELECT pair_id, sha256(c) AS inner, sha256(c) AS bare, sha256({_OPEN}) AS open, sha256('> ' || c || ' <') AS plain, sha256(c) AS outside FROM x",
}
