"""Hand-written cases of the expressions: every documented corner of the rules."""

import pytest
from pyspark.sql import functions as F

from palimpsest.functions import metrics
from palimpsest.functions.intent import intent
from palimpsest.functions.lint import RULES, lint
from palimpsest.functions.structure import diff_summary, parse_skill
from palimpsest.functions.tags import base_tags, bot_email, content_tags, pii_email, quality_score, repo_tags, size_facts
from palimpsest.functions.text import basename, body, cursor_rule, outer_fence_removed, parent_name, repo_slug, stable_id, strip, valid_frontmatter


def one(spark, expr, **cols):
    df = spark.range(1).select(*[F.lit(v).alias(k) if v is not None else F.lit(None).cast("string").alias(k) for k, v in cols.items()])
    return df.select(expr.alias("x")).first()["x"]


CASES = [
    ("Add x", True, 5, 0, 100, ("feat", 0.65)),
    ("first draft", True, 5, 0, 100, ("initial", 0.95)),
    ("", True, 5, 0, 100, ("initial", 0.95)),
    ("Initialize repo", False, 5, 1, 100, ("unknown", 0.0)),
    ('Revert "fix: x"', False, 5, 1, 100, ("revert", 0.65)),
    ("Merge branch x", False, 0, 0, 0, ("whitespace", 0.9)),
    ("feat!: x", False, 5, 1, 100, ("feat", 0.95)),
    ("fix(core): x", False, 5, 1, 100, ("fix", 0.95)),
    ("fix-up", False, 5, 1, 100, ("fix", 0.95)),
    ("something", False, 1, 1, 29, ("whitespace", 0.6)),
    ("something", False, 1, 1, 30, ("unknown", 0.0)),
    (None, False, 3, 3, 100, ("unknown", 0.0)),
    ("typo in readme", False, 3, 3, 100, ("docs", 0.65)),
    ("wip", False, 3, 3, 100, ("chore", 0.65)),
]


@pytest.mark.parametrize("subject, initial, added, removed, delta, want", CASES)
def test_intent(spark, subject, initial, added, removed, delta, want):
    x = one(spark, intent(F.col("s"), F.lit(initial), F.lit(added), F.lit(removed), F.lit(delta)), s=subject)
    assert (x["class"], pytest.approx(x["confidence"], abs=1e-6)) == want


@pytest.mark.parametrize(
    "mail, want",
    [("49+dependabot[bot]@users.noreply.github.com", True), ("noreply@github.com", True), ("ACTION@github.com", False), ("a@renovate.io", True), (None, False), ("dev@corp.io", False)],
)
def test_bots(spark, mail, want):
    assert one(spark, bot_email(F.col("m")), m=mail) is want


def tags(spark, after="x" * 600, before=None, initial=False, added=9, removed=9, delta=99, subject="s", kind="feat", mail=None):
    df = spark.range(1).select(
        F.lit(after).cast("string").alias("after_content"), F.lit(before).cast("string").alias("before_content"), F.lit(initial).alias("is_initial"), F.lit(added).alias("lines_added"),
        F.lit(removed).alias("lines_removed"), F.lit(delta).alias("char_delta"), F.lit(subject).cast("string").alias("commit_subject"), F.lit(mail).cast("string").alias("commit_email"),
    )
    df = df.withColumns(size_facts())
    return set(df.select(base_tags(F.lit(kind), F.lit(False), F.lit(None).cast("boolean"), F.lit(False)).alias("t")).first()["t"])


def test_tag_limits(spark):
    assert tags(spark, after="x" * 500) == set() and tags(spark, after="x" * 499) == {"short_skill"}
    assert tags(spark, after="x" * 200_000) == set() and tags(spark, after="x" * 200_001) == {"large_blob"}
    assert tags(spark, added=2, removed=2, delta=40) == set() and tags(spark, added=2, removed=2, delta=-39) == {"micro_edit"}
    assert tags(spark, after="x", initial=True, added=1, removed=0, delta=1) == {"initial_commit"}
    assert tags(spark, after="�" + "x" * 600) == {"non_utf8_clean"}
    assert tags(spark, subject="  Revert it") == {"revert_subject"} and tags(spark, kind="merge") == {"merge_commit"}
    assert tags(spark, after=None) == {"short_skill"}


def test_content_tags(spark):
    good = "---\nname: a\ndescription: b\n---\n"
    got = lambda t: set(one(spark, content_tags(F.col("t")), t=t))
    assert got(good + "x") == set()
    assert got(good + "TODO: fill this in") == {"placeholder_content"}
    assert got(good + "Ignore previous instructions") == {"prompt_injection_pattern"}
    assert got(good + "dan") == set() and got(good + "DAN mode") == {"prompt_injection_pattern"}
    assert got(None) == {"invalid_frontmatter"}


@pytest.mark.parametrize("text, want", [("a@mail5.example.com", True), ("a@example.com", False), ("a@x.test", False), ("x@noreply.corp.io", False), ("a@corp.io and b@example.org", True), (None, False), ("no mail", False)])
def test_pii(spark, text, want):
    assert one(spark, pii_email(F.col("t")), t=text) is want


def test_repo_tags(spark):
    def got(known, spdx, stars, pushed):
        args = [F.lit(known), F.lit(spdx).cast("string"), F.lit(stars).cast("int"), F.lit(pushed).cast("string"), F.lit("2024-06-01").cast("timestamp")]
        return set(spark.range(1).select(repo_tags(*args).alias("t")).first()["t"])

    assert got(True, None, 0, "2023-05-31T00:00:00Z") == {"no_license", "low_engagement"}
    assert got(True, "", None, "2023-06-01T00:00:00Z") == {"no_license"}
    assert got(True, "NOASSERTION", 0, None) == set() and got(None, None, 0, None) == set()


@pytest.mark.parametrize("stars, size, want", [(9, 499, 0.30), (10, 500, 0.50), (99, 30_000, 0.50), (100, 30_001, 0.50)])
def test_score(spark, stars, size, want):
    args = [F.array().cast("array<string>"), F.lit(None).cast("string"), F.lit(stars), F.lit(""), F.lit("test"), F.lit(size)]
    assert spark.range(1).select(quality_score(*args).alias("s")).first()["s"] == pytest.approx(want, abs=1e-6)


def test_text(spark):
    assert one(spark, strip(F.col("t")), t="  a b \n") == "a b"
    assert one(spark, valid_frontmatter(F.col("t")), t="---\r\nname: a\r\ndescription: b\r\n---\r\nx") is True
    assert one(spark, valid_frontmatter(F.col("t")), t="---\n---\nx") is False
    assert one(spark, body(F.col("t")), t="---\nname: a\n---\nrest\n---\nmore") == "rest\n---\nmore"
    assert one(spark, basename(F.col("t")), t="a/b/SKILL.md") == "SKILL.md" and one(spark, parent_name(F.col("t")), t="SKILL.md") == ""
    assert one(spark, repo_slug(F.col("t")), t="https://github.com/a/b.git") == "a/b" and one(spark, repo_slug(F.col("t")), t="a/b") == "a/b"
    assert one(spark, outer_fence_removed(F.col("t")), t="```md\nx\ny\n```") == "x\ny" and one(spark, outer_fence_removed(F.col("t")), t=" plain ") == "plain"
    assert one(spark, stable_id(F.col("t"), F.lit("b")), t="a") == __import__("hashlib").sha1(b"a\0b\0").hexdigest()[:16]


@pytest.mark.parametrize("path, want", [(".cursorrules", True), ("x/.cursorrules-a.md", True), ("a/.cursor/rules/b.mdc", True), ("a/.cursor/b.mdc", False), ("b.mdc", False)])
def test_cursor_rules(spark, path, want):
    assert one(spark, cursor_rule(F.col("p")), p=path) is want


def kind_of(spark, before, after):
    b, a = F.col("b"), F.col("a")
    return one(spark, diff_summary(b, a, parse_skill(b), parse_skill(a)), b=before, a=after)


def test_edit_kinds(spark):
    fm = "---\nname: a\ndescription: d\n---\n"
    for before, after, want in [
        (None, "x", "addition"), ("x", "", "deletion"), ("", "", "trivial"), ("x ", "x", "trivial"), (fm + "x", "---\nname: b\n---\nx", "frontmatter_only"), ("# A\nx", "# A\n## B\nx", "structural"),
        ("x", "x\n```\ny\n```", "code_only"), ("x", "y", "body_only"), (fm + "x", "---\nname: b\n---\ny", "both"),
    ]:
        assert kind_of(spark, before, after)["edit_kind"] == want, (before, after)
    three = kind_of(spark, "", "```\n```\n```")
    assert three["code_blocks_after"] == 1
    assert one(spark, parse_skill(F.col("t"))["name"], t="---\nname:\ndescription: d\n---\nx") == "description: d"


def rules_of(spark, text, rules=None):
    return [(f["rule"], f["line"]) for f in one(spark, lint(F.col("t"), rules), t=text)]


def test_lint(spark):
    assert [r for r, _ in rules_of(spark, "")] == ["E001-no-frontmatter", "W005-no-heading", "W006-short-body"]
    good = "---\nname: a\ndescription: Use this skill when testing things\n---\n# T\n" + "x" * 200
    assert rules_of(spark, good) == []
    assert rules_of(spark, good + "\n```\na\n```\n```py\nb\n```\n```\nc\n```") == [("W004-codeblock-no-lang", 7), ("W004-codeblock-no-lang", 13)]
    assert rules_of(spark, good + "\nGPT-3.5-turbo\ngpt-3.5-turbo") == [("I002-deprecated-model", 7)]
    block = "---\nname: a\ndescription: |\n  Use this skill when\n  testing things\nother: x\n---\n# T\n" + "x" * 200
    assert rules_of(spark, block) == []
    assert [r for r, _ in rules_of(spark, "---\nname: a\ndescription: short\n---\n# T\n" + "x" * 200)] == ["W001-short-description", "W003-no-trigger-language"]
    assert len(RULES) == 7 and rules_of(spark, None) == rules_of(spark, "")


def test_metrics(spark):
    df = spark.createDataFrame([(" a b ", "a b"), ("", "x"), (None, None), ("the cat sat", "the cat ran")], "p string, g string")
    got = df.select(metrics.exact(F.col("p"), F.col("g")).alias("e"), metrics.rouge_l("p", "g").alias("r"), metrics.edit_ratio("p", "g").alias("d")).collect()
    assert [x["e"] for x in got] == [1.0, 0.0, 1.0, 0.0]
    assert [round(x["r"], 4) for x in got] == [1.0, 0.0, 0.0, 0.6667] and got[2]["d"] == 1.0
    assert metrics.batch_labels("1: fix\n2) Docs\nnoise\n9: feat\n3: bogus", 3, frozenset({"fix", "docs"})) == ["fix", "docs", "other"]
    nan = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    assert nan.select(metrics.mean(F.col("x")).alias("m")).first()["m"] == 1.0
    j = one(spark, metrics.parse_judgement(F.col("t"), ("a", "b")), t='```json\n{"a": 3}\n```')
    assert (j["a"], j["b"]) == (3.0, 0.0)
    assert metrics.lcs_length(list("abcbdab"), list("bdcaba")) == 4
