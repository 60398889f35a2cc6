"""Operators, sources, sinks and streams on small fixtures."""

import json
import random
import subprocess
import tarfile

import pytest
from pyspark.sql import functions as F

from palimpsest.functions import text
from palimpsest.operators import chain, dims, minhash, subset, vectors
from palimpsest.operators.components import connected_components
from palimpsest.operators.records import fuller, once
from palimpsest.plans import evaluation
from palimpsest.sources import archives, files, githistory, paged, sinks
from palimpsest.streaming import events


def test_components_against_union_find(spark):
    r = random.Random(1)
    pairs = [(r.randint(0, 400), r.randint(0, 400)) for _ in range(250)] + [(i, i + 1) for i in range(1000, 1060)] + [(5000, k) for k in range(2000, 2100)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    df = spark.createDataFrame([*pairs, (None, 3), (7, None)], "src bigint, dst bigint")
    got = {x["node"]: x["component"] for x in connected_components(df).collect()}
    loops = {a for a, b in pairs if a == b}
    assert got == {x: find(x) for x in parent if x not in loops or x in got}
    assert connected_components(df.limit(0)).count() == 0


def test_fuller_and_once(spark):
    rows = [("a", "x", None, 1), ("a", "x", "t", 1), ("b", None, None, 2), ("b", None, None, 2), (None, "z", "z", 3)]
    df = spark.createDataFrame(rows, "k string, u string, v string, n int")
    want = {("a", "x", "t"), ("b", None, None)}
    assert {tuple(x) for x in fuller(df, "k", ["u", "v"]).collect()} == want == {tuple(x) for x in once(df, "k", ["u", "v"]).collect()}
    assert fuller(df.limit(0), "k", ["u"]).count() == 0


def test_seen_before_is_the_same_on_any_layout(spark):
    r = random.Random(3)
    rows = [(i, r.choice("abcd"), i % 50) for i in range(300)]
    want = set()
    met = set()
    for i, k, o in sorted(rows, key=lambda x: (x[2], x[0])):
        if k in met:
            want.add(i)
        met.add(k)
    for n in (1, 17):
        df = spark.createDataFrame(rows, "id int, k string, o int").repartition(n)
        got = {x["id"] for x in chain.seen_before(df, ["k"], ["o", "id"], "dup").where("dup").collect()}
        assert got == want


def test_chains(spark):
    df = spark.createDataFrame([("p", 1, "a", "s"), ("p", 2, None, "Revert x"), ("p", 3, "c", "s"), ("q", 1, "d", "s")], "p string, o int, v string, s string")
    got = {(x["p"], x["o"]): (x["before"], x["is_first"]) for x in chain.with_previous(df, ["p"], ["o"], "v", "before").collect()}
    assert got == {("p", 1): (None, True), ("p", 2): ("a", False), ("p", 3): ("a", False), ("q", 1): (None, True)}
    assert [x["o"] for x in chain.before_revert(df, ["p"], ["o"], "s").where("pre_revert").collect()] == [1]
    latest = chain.latest_per_key(df, ["p"], ["o"]).where("p = 'p'").first()
    assert latest["o"] == 3 and chain.first_per_key(df, ["p"], ["o"]).where("p = 'p'").first()["o"] == 1
    ids = {x["p"]: x["id"] for x in chain.dense_ids(df, "p", "o", "c").collect()}
    assert ids == {"p": "c0000000", "q": "c0000001"}


def test_pull_requests(spark):
    rows = [("r", 1, "t1", "m1", "h1"), ("r", 2, "t2", "h1", "h2"), ("r", 3, "t3", "same", "same"), ("r", 4, "t4", None, "")]
    prs = spark.createDataFrame(rows, "repo string, n int, title string, m string, h string")
    got = {x["sha"]: (x["n"], x["pr_match_kind"]) for x in dims.pull_requests(prs, "repo", "n", "m", "h", ["title"]).collect()}
    assert got == {"m1": (1, "merge_commit_sha"), "h1": (1, "head_sha"), "h2": (2, "head_sha"), "same": (3, "merge_commit_sha")}


def test_below_directory(spark):
    f = spark.createDataFrame([(p,) for p in ("a/x", "a/b/y", "a/b/SKILL.md", "top", "ab/z", "c/d/e/f")], "path string")
    d = spark.createDataFrame([(x, x) for x in ("a", "a/b", "", "c/d")], "dir string, held string")
    got = {x["path"]: x["held"] for x in dims.below_directory(f, "path", d, "dir").collect()}
    assert got == {"a/x": "a", "a/b/y": "a", "a/b/SKILL.md": "a", "top": "", "c/d/e/f": "c/d"}


def test_unions_and_labels(spark):
    a = spark.createDataFrame([(1, "x", 1.5)], "k bigint, s string, only double")
    b = spark.createDataFrame([("y", 1), ("z", 2)], "s string, k int")
    assert {tuple(x) for x in dims.aligned_union(a, b).collect()} == {(1, "x", 1.5), (1, "y", None), (2, "z", None)}
    assert {tuple(x) for x in dims.left_wins(a, b, "k").collect()} == {(1, "x", 1.5), (2, "z", None)}
    labels = spark.createDataFrame([(1, "new"), (2, "new")], "k bigint, label string")
    out = dims.relabel(dims.aligned_union(a, b), labels, "k", F.col("only").isNull(), {"s": F.col("label")})
    assert {tuple(x) for x in out.collect()} == {(1, "x", 1.5), (1, "new", None), (2, "new", None)}


def test_stratified_is_stable(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 3).alias("s"))
    a, b = ({x["k"] for x in subset.stratified(d, "k", "s", 7, 42).collect()} for d in (df, df.repartition(9)))
    assert a == b and len(a) == 21


def test_eval_limits(spark):
    got = lambda b, a, t: spark.range(1).select(subset.evaluable(F.lit("x" * b), F.lit("x" * a), F.lit(t)).alias("k")).first()["k"]
    assert got(1000, 300, "twelve chars") and got(200, 600, "twelve chars")
    assert not got(1000, 299, "twelve chars") and not got(200, 601, "twelve chars") and not got(199, 300, "twelve chars") and not got(300, 300, "eleven char")


def test_minhash_clusters(spark):
    words = " ".join(f"w{i}" for i in range(300))
    rows = [(1, words), (2, words + " tail"), (3, " ".join(f"v{i}" for i in range(300))), (4, ""), (5, None)]
    got = {x["k"]: (x["cluster"], x["is_canonical"]) for x in minhash.clusters(spark.createDataFrame(rows, "k bigint, t string"), "k", "t").collect()}
    assert got == {1: (1, True), 2: (1, False), 3: (3, True), 4: (4, True), 5: (4, False)}


def test_neighbours_against_brute_force(spark):
    import numpy as np

    m = np.random.default_rng(1).normal(size=(150, 8)).astype("float32")
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)] + [(900, None)], "id bigint, v array<float>")
    got = vectors.neighbours(df, df.where("id % 50 = 0 and v is not null"), "id", "v", 5).toPandas()
    for q in (0, 50, 100):
        want = np.argsort(-(m.astype(float) @ m[q].astype(float)), kind="stable")[:5]
        assert list(got[got["query"] == q].sort_values("rank")["id"]) == list(want)


def test_an_index_of_cells(spark):
    import numpy as np

    r = np.random.default_rng(2)
    base = r.normal(size=(12, 16))
    m = (base[np.arange(900) % 12] + 0.3 * r.normal(size=(900, 16))).astype("float32")
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)] + [(9000, None), (9001, [1.0])], "id bigint, v array<float>")
    q = df.where("id % 60 = 0")
    c = vectors.centres(df.where("id < 900"), "id", "v")
    assert c.shape == (30, 16)
    every = {(x["query"], x["id"]) for x in vectors.neighbours(df, q.where("id < 900"), "id", "v", 5).collect()}
    part = {(x["query"], x["id"]) for x in vectors.indexed_neighbours(df, q, "id", "v", 5, c, 8).collect()}
    whole = {(x["query"], x["id"]) for x in vectors.indexed_neighbours(df, q, "id", "v", 5, c, 30).collect()}
    assert whole == every and len(part & every) >= 0.9 * len(every) and len(part) == len(every)


def test_encoders_give_unit_vectors(spark):
    df = spark.createDataFrame([("a", "x" * 3000), ("b", None)], "k string, t string")
    got = {x["k"]: x["embedding"] for x in vectors.encode(df, "k", "t", lambda texts: [[float(len(t)), 1.0] for t in texts]).collect()}
    assert got["a"][0] == pytest.approx(2000 / (2000**2 + 1) ** 0.5) and got["b"] == [0.0, 1.0]


def test_uploads(spark, tmp_path):
    (tmp_path / "f" / "x").mkdir(parents=True)
    (tmp_path / "f" / "x" / "a.txt").write_text("abc")
    (tmp_path / "f" / "b.txt").write_text("no")

    def put(name, path):
        if name == "b.txt":
            raise OSError("refused")

    folder = str(tmp_path / "f")
    assert sinks.upload(spark, folder, put).agg(F.sum("bytes")).first()[0] == 5
    assert {(x["path"].rsplit("/", 1)[-1], x["status"]) for x in sinks.upload(spark, folder, put, dry_run=False).collect()} == {("a.txt", "ok"), ("b.txt", "refused")}


def test_shared_folder_and_release(spark, monkeypatch):
    from palimpsest import session

    t = session.materialize(spark.range(3))
    assert t.count() == 3 and t._palimpsest_path in session._held
    session.release_all(spark)
    assert not session._held

    class Cluster:
        class conf:
            get = staticmethod(lambda key, default=None: None)

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(RuntimeError, match="checkpoint.dir"):
        session.shared_dir(Cluster())


def test_ordered_jsonl(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"k": "1", "v": 1}\n\nnot json\n{"v": 2}\n{"k": "2"}')
    rows = files.ordered_jsonl(spark, str(tmp_path), "k string, v int", "k").collect()
    assert sorted((x["line_no"], x["k"], x["v"]) for x in rows) == [(1, "1", 1), (5, "2", None)]


def test_other_files(spark, tmp_path):
    d = tmp_path / "docs"
    d.mkdir()
    (d / "a.json").write_text(json.dumps({"repo": "r", "status": "ok"}, indent=1))
    (d / "b.json").write_text("{broken")
    assert [x["repo"] for x in files.json_documents(spark, str(d), "repo string, status string", F.col("status") == "ok").collect()] == ["r"]
    (tmp_path / "n.txt").write_text(" a \n\nb\n")
    assert [x["name"] for x in files.names(spark, str(tmp_path / "n.txt")).collect()] == ["a", "b"]
    log = spark.createDataFrame([("r", "error", 1), ("r", "ok", 2), ("s", "ok", 1)], "repo string, status string, at int")
    sinks.append_journal(log.where("at = 1"), str(tmp_path / "j"))
    sinks.append_journal(log.where("at = 2"), str(tmp_path / "j"))
    assert {x["repo"]: x["status"] for x in files.journal(spark, str(tmp_path / "j"), "repo string, status string, at int", "repo", "at").collect()} == {"r": "ok", "s": "ok"}
    (tmp_path / "x.log").write_text("start\n[9/10] eta=4s\n[7/1,000] eta=90s\nlast words\n")
    (tmp_path / "y.log").write_text("3/3\nexit: 0\n")
    (tmp_path / "z.log").write_text("nothing yet\n")
    logs = {x["file_name"]: tuple(x)[1:] for x in files.log_progress(spark, str(tmp_path / "*.log")).collect()}
    assert logs == {"x.log": (7, 1000, 90, False), "y.log": (3, 3, None, True)}
    (d / "SKILL.md").write_bytes(b"ok")
    assert [x["content"] for x in files.markdown_files(spark, str(tmp_path)).collect()] == ["ok"]


def test_versions_and_routes(spark, tmp_path):
    t = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        sinks.read_current(spark, t)
    sinks.write_version(spark.range(3), t)
    sinks.write_version(sinks.read_current(spark, t).where("id > 0"), t)  # from itself
    assert sinks.read_current(spark, t).count() == 2
    assert len(list((tmp_path / "t" / "CURRENT").glob("0*"))) == 2, "no pointer is ever taken away"
    for _ in range(10):
        last = sinks.write_version(spark.range(1), t)
    assert sinks._pointers(spark, t)[-1].endswith(last)
    sinks.route(spark.range(10), {"all": None, "even": F.col("id") % 2 == 0}, str(tmp_path / "r"))
    assert sinks.read_current(spark, str(tmp_path / "r" / "even")).count() == 5


def test_other_sinks(spark, tmp_path):
    df = spark.createDataFrame([("b/x", "é", 1), ("a/y", "z", 2), (None, "n", 3)], "repo string, text string, n int")
    sinks.write_lines(df, "repo", str(tmp_path / "l"))
    assert [x["name"] for x in files.names(spark, str(tmp_path / "l")).collect()] == ["a/y", "b/x"]
    sinks.write_documents(df.limit(2), str(tmp_path / "d"), by="repo")
    assert "é" in "".join(p.read_text() for p in (tmp_path / "d" / "__by=b__x").glob("*.json"))
    sinks.write_mapping(df.union(df), "repo", "text", str(tmp_path / "m"))
    assert {x["key"]: x["value"] for x in spark.read.json(str(tmp_path / "m")).collect()} == {"b/x": "é", "a/y": "z"}
    base = str(tmp_path / "e")
    for stamp, model, score in (("20240101-000000", "p:a/b", 0.1), ("20240102-000000", "p:a/b", 0.2), ("20240101-000000", "identity", 0.3)):
        scores = spark.createDataFrame([(model, "1", "fix", None, score)], "model string, pair_id string, intent_class string, error string, exact double")
        sinks.write_result(scores, evaluation.summary(scores), model, base, stamp)
    assert (tmp_path / "e" / "20240102-000000__p_a_b").exists()
    latest = {x["model"]: x["exact"] for x in chain.latest_per_key(files.results(spark, base), ["model"], ["stamp", "path"]).collect()}
    assert latest == {"p:a/b": 0.2, "identity": 0.3}
    assert [x["stamp"] for x in chain.last_n(files.results(spark, base), ["stamp", "model"], 1).collect()] == ["20240102-000000"]
    spark.range(7).coalesce(1).write.parquet(str(tmp_path / "q"))
    assert [(x["rows"], x["bytes"] > 0) for x in files.row_counts(spark, str(tmp_path / "q")).collect()] == [(7, True)]


def test_staged_shards(spark, tmp_path):
    spark.range(5).coalesce(1).write.parquet(str(tmp_path / "src"))
    one = next((tmp_path / "src").glob("*.parquet")).read_bytes()
    got = files.staged_shards(spark, ["https://x/1", "https://x/2"], lambda url: one, str(tmp_path / "stage"))
    assert got.count() == 10 and files.staged_shards(spark, ["https://x/1"], lambda url: 1 / 0, str(tmp_path / "stage")).count() == 5


def test_archives(spark, tmp_path):
    src = tmp_path / "r-abc"
    src.mkdir()
    (src / "a.txt").write_text("text")
    (src / "b.bin").write_bytes(b"\xff\xfe\x00")
    (src / "c.txt").write_text("y" * 50)
    with tarfile.open(tmp_path / "x.tar.gz", "w:gz") as tar:
        tar.add(src, arcname="r-abc1234")
    (tmp_path / "bad.tar.gz").write_bytes(b"no archive")
    (tmp_path / "big.tar.gz").write_bytes(b"x" * 5000)
    rows = archives.tar_members(spark, str(tmp_path / "*.tar.gz"), most_content=20, most_bytes=4000).collect()
    got = {x["path"]: (x["root"], x["head_sha"], x["size"], x["content"], x["binary_or_oversize"]) for x in rows if x["status"] == "ok"}
    assert got == {"a.txt": ("r-abc1234", "abc1234", 4, "text", False), "b.bin": ("r-abc1234", "abc1234", 3, None, True), "c.txt": ("r-abc1234", "abc1234", 50, None, True)}
    assert {(x["archive"].rsplit("/", 1)[-1], x["status"]) for x in rows if x["status"] != "ok"} == {("bad.tar.gz", "broken"), ("big.tar.gz", "too_large")}


def test_git_history(spark, tmp_path):
    repo = tmp_path / "repo"
    (repo / "s").mkdir(parents=True)
    git = lambda *a: subprocess.run(["git", "-C", str(repo), "-c", "user.name=A", "-c", "user.email=a@b.c", *a], check=True, capture_output=True)
    git("init", "-q")
    for i, text in enumerate(["one\n", "one\ntwo\n"]):
        (repo / "s" / "SKILL.md").write_text(text)
        git("add", "-A")
        git("commit", "-q", "-m", f"feat: step {i}")
    spark.dataSource.register(githistory.GitHistory)
    rows = sorted(spark.read.format("githistory").option("repos", str(repo)).load().collect(), key=lambda x: not x["is_initial"])
    assert [(x["skill_name"], x["before_content"], x["after_content"], x["lines_added"], x["char_delta"]) for x in rows] == [("s", None, "one\n", 1, 4), ("s", "one\n", "one\ntwo\n", 1, 4)]
    assert rows[1]["before_sha"] == rows[0]["after_sha"]
    assert githistory.numstat("-\t-\tx") == (0, 0) and githistory.log_records("a\x1fb\x1e") == []


def test_git_history_of_a_repository_with_everything(spark, tmp_path):
    repo = tmp_path / "repo"
    (repo / "old").mkdir(parents=True)
    (repo / ".cursor" / "rules").mkdir(parents=True)

    def git(*a):
        return subprocess.run(["git", "-C", str(repo), "-c", "user.name=A", "-c", "user.email=a@b.c", *a], check=True, capture_output=True, text=True).stdout.strip()

    def commit(path, data, subject):
        (repo / path).parent.mkdir(parents=True, exist_ok=True)
        (repo / path).write_bytes(data)
        git("add", "-A")
        git("commit", "-q", "-m", subject)

    git("init", "-q", "-b", "main")
    body = b"".join(b"line %d of a long enough text\n" % i for i in range(30))
    commit("old/skill.md", body.replace(b"line", b"other words entirely"), "first")
    git("mv", "old", "moved")
    git("commit", "-q", "-m", "move")
    commit("new/SKILL.md", body, "start")
    commit("new/SKILL.md", body + b"two\n", "grow")
    commit("new/SKILL.md", b"\xff\xfe bad", "not text")
    commit("new/SKILL.md", body + b"three\nfour\n", "text again")
    git("checkout", "-q", "-b", "side", "HEAD~1")
    commit(".cursor/rules/style.mdc", b"rule\n", "rule")
    git("checkout", "-q", "main")
    git("merge", "-q", "--no-ff", "-m", "merge side", "side")
    commit(".cursorrules", b"root\n", "root rule")
    githistory.register(spark)
    rows = spark.read.format("githistory").option("repos", str(repo)).load().collect()
    rows = {x["commit_subject"]: x for x in rows}
    # before its move a file has another name, so the move is its first revision; what is no text is passed over
    assert set(rows) == {"move", "start", "grow", "text again"}
    assert all(rows[k]["is_initial"] and rows[k]["lines_added"] == 30 for k in ("move", "start"))
    again = rows["text again"]
    assert (again["lines_added"], again["lines_removed"], again["before_sha"]) == (2, 1, rows["grow"]["after_sha"]), "compared with the last text, not with the parent"
    rules = spark.read.format("githistory").option("repos", str(repo)).option("kind", "cursor").load().collect()
    assert {(x["skill_path"], x["skill_name"]) for x in rules} == {(".cursor/rules/style.mdc", "style"), (".cursorrules", "cursorrules-root")}
    with pytest.raises(Exception, match="ls-tree"):
        spark.read.format("githistory").option("repos", str(tmp_path)).load().count()
    with pytest.raises(Exception, match="no such kind"):
        spark.read.format("githistory").option("repos", str(repo)).option("kind", "x").load().count()


@pytest.mark.parametrize("path", [".cursorrules", "a/.cursorrules-zh.md", "a/.cursorrules.mdx", ".cursor/rules/a.mdc", "x/.cursor/rules/b/c.MD", "rules/a.mdc", ".cursor/rules", ".cursorrules.py", ".mdc", "a.mdc"])
def test_rules_in_python_and_in_spark_agree(spark, path):
    c = F.lit(path)
    row = spark.range(1).select(text.cursor_rule(c).alias("a"), text.rule_name(c).alias("b")).first()
    assert (row["a"], row["b"]) == (githistory.is_rule(path), githistory.rule_name(path))


def test_paged_sources(spark):
    def fetch(key, page):
        if key == "gone":
            return 404, []
        if key == "down":
            return 500, []
        return 200, [{"n": page * 10 + i} for i in range(2 if page < 3 else 1)]

    keys = spark.createDataFrame([("a",), ("gone",), ("down",), ("a",), (None,)], "k string")
    how = {"page_size": 2, "retries": 1, "pause": 0.0}
    got = {x["key"]: (x["status"], x["n_items"]) for x in paged.pages(keys, "k", fetch, **how).collect()}
    assert got == {"a": ("ok", 5), "gone": ("not_found", 0), "down": ("error", 0)}
    held = paged.pages(keys, "k", fetch, **how).where("key <> 'a'")
    again = {x["key"]: x["status"] for x in paged.refreshed(held, keys.where("k is not null"), "k", lambda k, p: (200, []), **how).collect()}
    assert again == {"a": "ok", "gone": "not_found", "down": "ok"}


def test_evaluation(spark):
    rows = [("1", "fix", "say b", "a", "a"), ("2", "fix", "x", "a b", "a c"), ("3", None, "boom", "a", "a")]
    edits = spark.createDataFrame(rows, "pair_id string, intent_class string, intent_text string, before_content string, after_content string")

    def fragile(before, said):
        if said == "boom":
            raise RuntimeError("no answer")
        return before

    evaluation.PROVIDERS["stub"] = lambda name: fragile
    p = evaluation.predict(edits, evaluation.resolve("stub:x"), "stub:x")
    got = {x["intent_class"]: x for x in evaluation.summary(evaluation.scored(p, {"exact": evaluation.METRICS["exact_match"]})).collect()}
    assert (got["all"]["n"], got["all"]["n_ok"], got["all"]["exact"]) == (3, 2, 0.5) and got["unknown"]["n_ok"] == 0
    with pytest.raises(ValueError):
        evaluation.resolve("nobody:x")
    joined = evaluation.with_examples(p.select("pair_id"), edits.union(edits).withColumn("repo", F.lit("r")), ["repo"])
    assert joined.count() == 3 and {x["repo"] for x in joined.collect()} == {"r"}


def test_streams(spark, data, tmp_path):
    batch = spark.read.parquet(f"{data}/events.parquet")
    stream = events.read_stream(spark, data, batch.schema, "events.parquet")
    q = events.windowed_counts(stream, late="1 hour").writeStream.outputMode("complete").format("memory").queryName("w").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.sql("select sum(n) from w").first()[0] == batch.count()
    target = str(tmp_path / "held")
    for i in (1, 2):
        s = events.read_stream(spark, data, batch.schema, "events.parquet")
        s.writeStream.foreachBatch(events.append_new(spark, target, "user_id")).option("checkpointLocation", str(tmp_path / f"c{i}")).trigger(availableNow=True).start().awaitTermination()
        assert spark.read.parquet(target).count() == batch.select("user_id").distinct().count()


def test_registry_is_complete(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries()) and len(e.queries()) > 60
    with pytest.raises(KeyError):
        e.queries()["no such query"]
