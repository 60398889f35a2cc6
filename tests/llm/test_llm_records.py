"""Capping, splits, near-duplicates and overlaps against plain statements of the same."""

import random
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from palimpsest.llm import capping, neardup, overlap, splits
from palimpsest.llm.shingles import body_words, distinct_runs, jaccard, run_hashes


def cap_plainly(rows, limit):
    over = set()
    for dim in (1, 2):
        groups = defaultdict(list)
        for r in rows:
            if r[dim]:
                groups[r[dim]].append(r)
        for g in groups.values():
            g.sort(key=lambda r: (r[3] is None or r[3] != r[3], -(r[3] or 0) if r[3] == r[3] else 0, r[0]))
            over |= {r[0] for r in g[limit:]}
    return over


def test_cap_against_sorting(spark):
    r = random.Random(1)
    rows = [(f"{i:05d}", r.choice(["a", "a", "a", "b", "c", None, ""]), r.choice(["x", "y", "", None, "z"]), r.choice([None, float("nan"), 0.5, 0.5, 0.5, r.random()])) for i in range(600)]
    df = spark.createDataFrame([(*x, "clash") for x in rows], "id string, who string, mail string, q double, over string")
    for limit in (0, 1, 40, 150, 1000):
        got = capping.cap(df, "id", "q", {"w": F.col("who"), "m": F.col("mail")}, limit=limit)
        assert {x[0] for x in got.where("over").collect()} == cap_plainly(rows, limit), limit
        assert got.count() == 600


def test_cap_repeats_ties_and_nothing(spark):
    schema = "id string, who string, q float"
    rows = [("b", "w", 0.5), ("a", "w", 0.5), ("a", "w", 0.5), ("a", None, None), (None, "w", 0.9)]
    got = capping.cap(spark.createDataFrame(rows, schema), "id", "q", {"w": F.col("who")}, limit=1)
    assert sorted(map(tuple, got.collect())) == [("a", False), ("b", True)]
    assert capping.cap(spark.createDataFrame([], schema), "id", "q", {"w": F.col("who")}, share=0.1).count() == 0
    with pytest.raises(ValueError):
        capping.cap(spark.createDataFrame([], schema), "id", "q", {"w": F.col("who")})


def test_cap_with_endless_and_far_scores(spark):
    inf = float("inf")
    r = random.Random(9)
    scores = [inf, inf, -inf, 1.7e308, -1.7e308, 5e-324, 0.0, -5e-324, None, *[10.0**e for e in range(-300, 300, 25)], *[-(10.0**e) for e in range(-300, 300, 50)]]
    rows = [(f"{i:05d}", "a" if i % 4 else "b", None, s) for i, s in enumerate(r.sample(scores, len(scores)))]
    df = spark.createDataFrame(rows, "id string, who string, mail string, q double")
    for limit in (1, 3, 12, 20):
        got = capping.cap(df, "id", "q", {"w": F.col("who")}, limit=limit).where("over").collect()
        assert {x[0] for x in got} == cap_plainly(rows, limit), limit


def groups_plainly(rows):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for r in rows:
        for i, k in enumerate(r[1:]):
            if k:
                parent[find((i, k))] = find(r[0])
    least = {}
    for r in rows:
        least[find(r[0])] = min(least.get(find(r[0]), r[0]), r[0])
    return {r[0]: least[find(r[0])] for r in rows}


def test_groups_and_splits(spark):
    r = random.Random(2)
    rows = [(f"p{i:04d}", r.choice([f"r{i // 9}", None, ""]), f"s{i // 3}", r.choice([f"c{r.randint(0, 200)}", "", None])) for i in range(500)]
    df = spark.createDataFrame(rows, "pair_id string, repo string, skill string, cluster string")
    got = splits.tie_groups(df.union(df.limit(20)), "pair_id", ["repo", "skill", "cluster"], ["repo"]).cache()
    want = groups_plainly(rows)
    assert {x["pair_id"]: x["group_id"] for x in got.collect()} == want
    out = splits.assign_splits(got, "pair_id").toPandas()
    assert len(out) == 500 and out.groupby("group_id")["split"].nunique().max() == 1
    assert set(out["split"]) <= {"train", "validation", "test"}


def test_annealing_meets_proportions(spark):
    rows = [(f"p{i:05d}", f"g{i // 4}", f"l{i % 3}") for i in range(4000)]
    df = spark.createDataFrame(rows, "pair_id string, group_id string, label string")
    share = splits.assign_splits(df, "pair_id", "label").groupBy("split").count().toPandas().set_index("split")["count"] / 4000
    assert abs(share["train"] - 0.8) < 0.01 and abs(share["test"] - 0.1) < 0.01


def test_every_frequent_label_is_balanced(spark):
    names = "initial test unknown merge whitespace ci refactor build chore feat fix docs style perf revert".split()
    rows = [(f"p{i:05d}", f"g{i // 2}", names[i // 2 % 15]) for i in range(6000)]
    df = spark.createDataFrame(rows, "pair_id string, group_id string, label string")
    out = splits.balance(splits.assign_splits(df, "pair_id", "label").join(df.select("pair_id", "label"), "pair_id"), "label").collect()
    assert len(out) == 3 and all(x["within"] and x["label_deviation"] < 0.02 for x in out), out
    many = df.withColumn("label", F.concat("label", F.substring("pair_id", -2, 2)))
    assert splits.assign_splits(many, "pair_id", "label").groupBy("group_id").agg(F.countDistinct("split").alias("n")).where("n > 1").isEmpty()
    assert splits.balance(df.limit(0).withColumn("split", F.lit("train")), "label").count() == 0


def test_annealing_tries_every_component_of_a_full_shard():
    n = splits.SHARD
    label = np.arange(n) % splits.LABELS
    pdf = pd.DataFrame({"group_id": range(n), "size": 1, "labels": list(np.eye(splits.LABELS, dtype=int)[label]), "split": 1})
    whole = np.array([n, *np.bincount(label, minlength=splits.LABELS)], float)
    now = np.zeros((3, 1 + splits.LABELS))
    now[1] = whole
    got = splits._anneal(pdf, now - np.outer([0.8, 0.1, 0.1], whole), 1.0, whole, 5, 0.0)
    assert np.abs(np.bincount(got, minlength=3) / n - [0.8, 0.1, 0.1]).max() < 0.002


def test_groups_of_nothing(spark):
    df = spark.createDataFrame([], "pair_id string, repo string")
    assert splits.assign_splits(splits.tie_groups(df, "pair_id", ["repo"]), "pair_id").count() == 0
    lone = spark.createDataFrame([("a", None), ("b", "")], "pair_id string, repo string")
    assert {tuple(x) for x in splits.tie_groups(lone, "pair_id", ["repo"]).collect()} == {("a", "a"), ("b", "b")}


def edited(r, words):
    w = list(words)
    for _ in range(r.randint(0, 5)):
        w[r.randrange(len(w))] = f"new{r.randint(0, 999)}"
    return " ".join(w)


def corpus(n=120, seed=3):
    r = random.Random(seed)
    base = [[f"w{r.randint(0, 4000)}" for _ in range(r.randint(70, 200))] for _ in range(n // 6)]
    out = {f"k{i:03d}": "---\nname: x\n---\n" + edited(r, base[i % len(base)]) for i in range(n)}
    out["same1"] = out["same2"] = " ".join(base[0])
    return out | {"empty": "", "short": "a b c", "null": None, "spaces": " \n "}


def test_near_duplicates_against_all_pairs(spark):
    texts = corpus()
    df = spark.createDataFrame(list(texts.items()), "k string, text string")
    runs = {k: distinct_runs(t) for k, t in texts.items()}
    long = [k for k, t in texts.items() if len(body_words(t)) >= 60]
    want = {(a, b) for a in long for b in long if a < b and jaccard(runs[a], runs[b]) >= 0.7}
    members, pairs = neardup.similar_pairs(df, "k", 0.7, counts=False, least_words=60)
    got = {tuple(x) for x in neardup.member_pairs(members, pairs, "k").collect()}
    assert got == want and ("same1", "same2") in got
    members, pairs = neardup.similar_pairs(df, "k", 0.7)
    g = {x["k"]: x for x in neardup.groups(members, pairs, "k").collect()}
    assert g["same1"]["group_id"] == g["same2"]["group_id"] and "empty" not in g


def weighted(a, b):
    x, y = Counter(a.tolist()), Counter(b.tolist())
    both = sum((x & y).values())
    return both / max(1, sum((x | y).values()))


def test_near_duplicate_bags_against_all_pairs(spark):
    """Multiplicities are skewed: some runs stand many times in a text, and copies differ in how often."""
    r = random.Random(12)
    texts = {}
    for i in range(60):
        block = " ".join(f"b{i % 20}x{j}" for j in range(r.randint(6, 9)))
        rest = " ".join(f"w{i % 20}y{j}" for j in range(80))
        for v in range(3):
            texts[f"k{i:02d}{v}"] = f"{rest} " + f"{block} " * r.choice([1, 2, 8, 9, 10, 30])
    runs = {k: run_hashes(body_words(t)) for k, t in texts.items()}
    keys = sorted(texts)
    df = spark.createDataFrame(list(texts.items()), "k string, text string")
    for t in (0.7, 0.8):
        want = {(a, b) for a in keys for b in keys if a < b and weighted(runs[a], runs[b]) >= t}
        for slack in (neardup.SLACK, None):
            members, pairs = neardup.similar_pairs(df, "k", t, slack=slack)
            got = {tuple(x) for x in neardup.member_pairs(members, pairs, "k").collect()}
            assert got <= want and len(got) >= 0.999 * len(want) > 100, (t, slack, len(got), len(want))


def test_near_duplicates_of_nothing(spark):
    df = spark.createDataFrame([], "k string, text string")
    members, pairs = neardup.similar_pairs(df, "k", 0.8)
    assert neardup.member_pairs(members, pairs, "k").count() == 0


def test_bag_signatures_estimate_weighted_jaccard():
    r = np.random.default_rng(0)
    items = r.integers(0, 2**63, 400).astype(np.uint64)
    a, b = r.integers(1, 9, 400), r.integers(1, 9, 400)
    sig = neardup.bag_signatures(np.concatenate([items, items]), np.concatenate([a, b]), np.repeat([0, 1], 400), 2, m=4096)
    true = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((sig[0] == sig[1]).mean() - true) < 0.04


def test_overlap_against_all_pairs(spark):
    texts = corpus(90, 5)
    keys = list(texts)
    ev, tr = keys[::3], [k for i, k in enumerate(keys) if i % 3]
    runs = {k: distinct_runs(t) for k, t in texts.items()}
    want = {(a, b): jaccard(runs[a], runs[b]) for a in ev for b in tr if jaccard(runs[a], runs[b]) >= 0.7}
    e = spark.createDataFrame([(k, texts[k]) for k in ev] * 2, "key_e string, text string")
    t = spark.createDataFrame([(k, texts[k]) for k in tr], "key_t string, text string")
    got = {(x["key_e"], x["key_t"]): x["similarity"] for x in overlap.overlaps(e, t, 0.7).where("similarity >= 0.7").collect()}
    assert got == pytest.approx(want)
    assert overlap.overlaps(e.limit(0), t, 0.7).count() == 0
    assert overlap.overlaps(e, t.limit(0), 0.7).count() == 0


def test_containment_against_all_pairs(spark):
    r = random.Random(8)
    whole = {f"t{i:02d}": [f"w{r.randint(0, 900)}" for _ in range(r.randint(60, 600))] for i in range(40)}
    part = {}
    for i in range(60):
        src = whole[f"t{r.randrange(40):02d}"]
        n = r.choice([6, 8, 20, 60, len(src) // 2])
        b = r.randrange(max(1, len(src) - n))
        part[f"e{i:02d}"] = edited(r, src[b : b + n]).split() if i % 3 else src[b : b + n]
    runs = {k: distinct_runs(" ".join(w)) for k, w in (whole | part).items()}
    for c in (0.5, 0.8, 1.0):
        want = {}
        for a in part:
            for b in whole:
                both = len(np.intersect1d(runs[a], runs[b]))
                if len(runs[a]) and both >= c * len(runs[a]) - 1e-9:
                    want[a, b] = both / len(runs[a])
        e = spark.createDataFrame([(k, " ".join(w)) for k, w in part.items()], "key_e string, text string")
        t = spark.createDataFrame([(k, " ".join(w)) for k, w in whole.items()] * 2, "key_t string, text string").repartition(9)
        got = {(x["key_e"], x["key_t"]): x["containment"] for x in overlap.overlaps(e, t, c).collect()}
        assert len(want) > 15 and got == pytest.approx(want)


def test_overlap_takes_the_delivery_of_greatest_rank(spark):
    text = " ".join(f"w{i}" for i in range(40))
    e = spark.createDataFrame([("e", 1, text), ("e", 2, "other " * 30), ("f", 1, text), ("f", 1, None)], "key_e string, rank int, text string")
    t = spark.createDataFrame([("t", text)], "key_t string, text string")
    assert [(x["key_e"], x["containment"]) for x in overlap.overlaps(e, t).collect()] == [("f", 1.0)]


def test_partial_arrays_are_folded_in_a_tree(spark):
    def work(batches):
        whole = np.zeros(overlap.CHUNK * 2, np.int64)
        for b in batches:
            whole[b["id"].to_numpy()] += 1
        yield from overlap._chunks(whole)

    df = spark.range(0, overlap.CHUNK * 2, 3, 150)
    got = overlap._merge(df.mapInArrow(work, "task int, chunk int, part binary"), 150, np.add, overlap.CHUNK * 2, np.int64)
    assert (got == (np.arange(overlap.CHUNK * 2) % 3 == 0)).all()


def test_run_hashes_forget_frontmatter_and_line_ends():
    a = distinct_runs("---\nname: a\n---\nOne two three four five six")
    assert len(a) == 2 and (a == distinct_runs("---\r\nname: b\r\n---\r\none two  three\r\nfour five six")).all()
    assert len(distinct_runs("---\nunclosed one two three four")) == 2
    assert len(distinct_runs(None)) == len(distinct_runs("")) == 0


