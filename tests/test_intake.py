"""Intake, labelling, judging and paged services on small fixtures."""

import json
import math

import pytest
from pyspark.sql import functions as F

from palimpsest.functions import lint, metrics
from palimpsest.functions.text import duration, iso_time, safe_name
from palimpsest.operators import dims, minhash, subset
from palimpsest.plans import intake, labelling
from palimpsest.sources import paged

RAW = "repo string, skill_path string, before_sha string, after_sha string, before_content string, after_content string, commit_subject string, commit_email string, commit_date string, lines_added int, is_initial boolean"


def raw(spark, rows):
    return spark.createDataFrame(rows, RAW)


def test_defaults_of_records(spark):
    rows = [("r", "a/SKILL.md", None, "s1", None, None, "  feat: x \u00a0", None, None, None, None), ("r", None, None, "s", None, "t", "", None, None, 1, True), ("r", "p", None, None, None, "t", "", None, None, 1, True)]
    got = intake.normalised(raw(spark, rows), "claude_skill").collect()
    assert len(got) == 1 and got[0].__fields__ == list(intake.RECORD)
    x = got[0]
    assert (x["after_content"], x["commit_subject"], x["commit_author"], x["lines_added"], x["char_delta"], x["is_initial"], x["source_seed"]) == ("", "feat: x", "", 0, 0, False, "other")
    assert (x["before_content"], x["intent_class"], x["intent_source"]) == (None, "whitespace", "regex")
    assert intake.normalised(raw(spark, []), "x").count() == 0


def test_repeated_deliveries_and_platforms(spark):
    long = "x" * 600
    rows = [("r", "p", None, "s1", None, long, "first", "a@b.c", "2024-01-01T00:00:00Z", 3, True)] * 2 + [("r", "p", "s1", "s2", long, long + "y", "feat: more", "a@b.c", "2024-01-02T00:00:00Z", 9, False)]
    held = intake.normalised(raw(spark, rows), "claude_skill", [("huzey", spark.createDataFrame([("r",)], "repo string"))])
    assert held.count() == 2 and {x["source_seed"] for x in held.collect()} == {"huzey"}
    new = [("q", "p", None, "t1", None, long, "first", "a@b.c", "2023-01-01T00:00:00Z", 3, True), ("q", "p", "t1", "t2", long, long + "z", "feat: z", "a@b.c", "2023-01-02T00:00:00Z", 9, False)]
    out = intake.add_platform(held, raw(spark, new), "opencode_skill")
    tags = {x["after_sha"]: x["quality_tags"] for x in out.collect()}
    assert "duplicate_after" in tags["t1"] and "duplicate_pair" in tags["t1"] and "duplicate_after" not in tags["s1"] + tags["t2"]
    with pytest.raises(ValueError, match="there already"):
        intake.add_platform(out, raw(spark, new), "opencode_skill")


def test_bundles_without_what_they_should_have(spark):
    df = spark.createDataFrame([("r", "a/SKILL.md", None)], "repo string, skill_path string, bundled_files array<struct<path:string,size:bigint,content:string,binary_or_oversize:boolean>>")
    x = intake.bundled(df).first()
    assert (x["skill_dir"], x["bundled_count"], x["bundled_files"]) == ("", 0, [])
    assert intake.bundled(df.drop("bundled_files")).first()["bundled_files"] == []


def test_columns_that_may_be_missing(spark):
    df = spark.range(1).withColumn("a", F.lit(1))
    assert subset.present(df, ["id"], ["b", "a"]).columns == ["id", "a"]
    with pytest.raises(ValueError, match="missing: c"):
        subset.present(df, ["id", "c"])


def test_labels_by_a_failing_model(spark):
    calls = []

    def flaky(prompt):
        calls.append(prompt)
        if len(calls) < 3:
            raise RuntimeError("busy")
        return "1: FEAT\n2) nonsense\n3. docs\n9: fix\nnoise"

    assert labelling.ask(flaky, ["a", "b", "c"], pause=0.0) == ["feat", "other", "docs"] and "2: b" in calls[0]
    with pytest.raises(RuntimeError):
        labelling.ask(lambda p: 1 / 0 if False else (_ for _ in ()).throw(RuntimeError("down")), ["a"], tries=2, pause=0.0)

    def make():
        def client(prompt):
            if "bad" in prompt.rsplit("\n\n", 1)[1]:
                raise RuntimeError("no")
            return "1: fix\n2: fix"

        return client

    df = spark.createDataFrame([("1", "x"), ("2", "y"), ("3", "bad"), ("4", None), (None, "z")], "k string, s string").coalesce(1)
    got = {x["k"]: x["label"] for x in labelling.labels(df, "k", "s", make, size=2, tries=1, pause=0.0).collect()}
    assert got == {"1": "fix", "2": "fix"}, "a batch that fails is left for the next run"
    assert spark.range(1).select(labelling.cost(F.lit(101)).alias("c")).first()["c"]["calls"] == 3


def test_searches_and_documents_of_a_service(spark):
    def fetch(query, page):
        if query == "wide":
            return 200, [{"repo": f"r{page}{i}"} for i in range(2)]
        return 200, [{"repo": "a", "other": {"x": 1}}] if page == 1 else []

    q = spark.createDataFrame([("wide",), ("narrow",)], "q string")
    got = paged.search(q, "q", fetch, most=6, page_size=2, pause=0.0)
    assert {x["key"]: (x["status"], x["n_items"]) for x in got.collect()} == {"wide": ("capped", 6), "narrow": ("ok", 1)}
    assert {tuple(x) for x in paged.found_in(got.where("key = 'narrow'"), "repo", "repo_search").collect()} == {("a", "repo_search", "narrow")}
    prs = [{"number": 1, "title": "t", "body": None, "state": "open", "merged_at": None, "merge_commit_sha": "m", "head": {"sha": "h", "ref": "x"}, "html_url": "u", "labels": [1]}, {"number": 2, "head": None}]
    facts = [{"license": {"spdx_id": "MIT", "name": "MIT"}, "stargazers_count": 5, "default_branch": "main", "pushed_at": "p", "topics": []}]
    res = spark.createDataFrame([("r", "ok", 2, json.dumps(prs)), ("gone", "not_found", 0, "[]"), ("bare", "ok", 1, '[{"license": null}]'), ("f", "ok", 1, json.dumps(facts))], paged.SCHEMA)
    assert [(x["number"], x["head_sha"], x["merge_commit_sha"]) for x in paged.pull_requests(res.where("key = 'r'")).orderBy("number").collect()] == [(1, "h", "m"), (2, None, None)]
    rows = {x["repo"]: (x["license_spdx"], x["stars"], x["fetch_status"]) for x in paged.repository_facts(res.where("key <> 'r'"), "2024-01-01T00:00:00Z").collect()}
    assert rows == {"gone": (None, None, "not_found"), "bare": (None, None, "ok"), "f": ("MIT", 5, "ok")}


def test_metrics_by_models_and_metrics_that_fail(spark):
    df = spark.createDataFrame([("aa", "aa"), ("ab", "cd"), (None, "x")], "p string, g string")

    def encoder():
        return lambda texts: [[t.count("a"), t.count("b"), t.count("c") + 0.001] for t in texts]

    got = [x[0] for x in df.select(metrics.semantic_cosine(encoder)(F.col("p"), F.col("g"))).collect()]
    assert got[0] == pytest.approx(1) and got[1] < 0.1

    def judge():
        def client(prompt):
            if "INTENT:\nfail" in prompt:
                raise RuntimeError("no")
            return '```json\n{"faithfulness": 2, "preservation": 1, "format": 2, "overall": 4, "rationale": "{x}"}\n```' if "INTENT:\ngood" in prompt else "no JSON"

        return client

    df = spark.createDataFrame([("good",), ("odd",), ("fail",)], "i string")
    rows = [x[0] for x in df.select(metrics.judged(judge, F.lit("p"), F.lit("g"), F.col("i"), F.lit("{b}"))).collect()]
    assert rows[0]["overall"] == 4 and rows[1]["overall"] == 0 and rows[2] is None
    import pandas as pd

    out = metrics._guarded(lambda p, g: 1 / len(p), pd.Series(["a", "", None, "ab"]), pd.Series(["x"] * 4))
    assert out[0] == 1 and math.isnan(out[1]) and math.isnan(out[2]) and out[3] == 0.5
    assert spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double").select(metrics.mean(F.col("x"))).first()[0] == 1.0


def test_rules_of_others_and_files_that_cannot_be_read(spark):
    def shout(text):
        if "boom" in text:
            raise ValueError(text)
        return [("X001-shout", "info", "loud", 1, None)] if text.isupper() else []

    df = spark.createDataFrame([("AB",), ("boom",), (None,)], "t string")
    got = [[f["rule"] for f in x[0]] for x in df.select(lint.lint(F.col("t"), [lint.custom_rule("shout", shout), lint.frontmatter_rule])).collect()]
    assert got == [["X001-shout", "E001-no-frontmatter"], ["E001-no-frontmatter"], ["E001-no-frontmatter"]]
    files = spark.createDataFrame([("a", None), ("b", bytearray(b"\xff bad"))], "path string, content binary")
    got = {x["path"]: {f["rule"] for f in x["findings"]} for x in lint.lint_files(files).collect()}
    assert got["a"] == {"E000-read-error"} and "E001-no-frontmatter" in got["b"]


def test_small_forms(spark):
    row = spark.range(1).select(safe_name(F.lit("a/b")), duration(F.lit(3900)), duration(F.lit(59)), iso_time(F.lit("2024-01-02T03:04:05+01:00").cast("timestamp"))).first()
    assert tuple(row) == ("a__b", "1h05m", "0m", "2024-01-02T02:04:05Z")
    assert dims.known_keys([spark.createDataFrame([("a",), (None,)], "r string"), spark.createDataFrame([("a",), ("b",)], "r string")], "r").count() == 2


def test_near_duplicates_of_many_copies(spark):
    words = [f"w{i}" for i in range(200)]
    near = words[:]
    near[100] = "edited"
    rows = [(i, " ".join(words)) for i in range(300)] + [(900, " ".join(near)), (901, "a b c"), (902, "c b a"), (903, "a b d"), (904, "---\nname: x\n---\n" + " ".join(words))]
    got = {x["k"]: x["cluster"] for x in minhash.clusters(spark.createDataFrame(rows, "k bigint, t string"), "k", "t").collect()}
    assert {got[i] for i in [*range(300), 900, 904]} == {0} and got[901] == got[902] == 901 and got[903] == 903
