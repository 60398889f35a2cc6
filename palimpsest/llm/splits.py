"""Problem 3: splits that keep related records together.

Records are tied by equal keys (repository, skill, cluster); the tied groups are the connected components of the graph of keys,
found by star contractions. Method for the splits: component swap search. Components start from a hashed assignment; rounds of
parallel annealing then move or exchange whole components, each shard of them working against its share of the remaining
deviation of sizes and labels; the best assignment of all rounds is kept.

Defined results: null and '' tie nothing, a record without any key is a group of its own; repeated keys count once (the fuller
delivery); each of the LABELS most frequent labels is balanced by itself, rarer ones share REST classes by hash; an empty table
gives no rows. A component is never divided, so proportions are met as nearly as the largest component allows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.operators.components import connected_components
from palimpsest.operators.records import fuller
from palimpsest.session import materialize

SPLITS = (("train", 0.8), ("validation", 0.1), ("test", 0.1))
LABELS, REST = 48, 16
#: Components annealed together in one task.
SHARD = 20_000


def tie_groups(df: DataFrame, key: str, ties: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    """(key, group_id, extra): group_id is the smallest key of all records tied directly or through others."""
    once = materialize(fuller(df, key, [*dict.fromkeys([*ties, *extra])]))
    tokens = [F.when(F.col(c) != "", F.concat(F.lit(f"{i}:"), F.col(c))).alias(f"t{i}") for i, c in enumerate(ties)]
    rows = once.select(key, *extra, F.array_compact(F.array(*tokens)).alias("tokens"))
    pairs = rows.select(F.get("tokens", F.lit(0)).alias("src"), F.explode("tokens").alias("dst")).distinct()
    comp = connected_components(pairs)
    first = F.get("tokens", F.lit(0))
    # a token that is tied to no other is its own component
    named = rows.withColumn("node", first).join(comp, "node", "left").withColumn("component", F.coalesce("component", "node", F.concat(F.lit("-"), F.col(key))))
    named = materialize(named.select(key, *extra, "component"))
    least = named.groupBy("component").agg(F.min(key).alias("group_id"))
    return named.join(least, "component").select(key, "group_id", *extra)


def _anneal(pdf: pd.DataFrame, deviation: np.ndarray, share: float, scale: np.ndarray, seed: int, temperature: float) -> np.ndarray:
    """New splits of one shard's components; deviation (splits x features) is the whole corpus's, share this shard's part."""
    rng = np.random.default_rng(seed)
    feats = np.column_stack([pdf["size"].to_numpy(float), np.stack(pdf["labels"].to_numpy()).astype(float)]) / scale
    split = pdf["split"].to_numpy().copy()
    dev = deviation / scale * share
    k, n = dev.shape[0], len(split)
    cost = float((dev**2).sum())
    best, best_cost = split.copy(), cost
    steps = 40 * n
    heat = temperature * max(cost, 1e-12) / 10
    pick, to, mate, luck = rng.integers(0, n, steps), rng.integers(1, k, steps), rng.integers(0, n, steps), rng.random(steps)
    for i in range(steps):
        a, s = pick[i], split[pick[i]]
        if i & 1:  # exchange with a component of another split
            b = mate[i]
            t = split[b]
            if t == s:
                continue
            delta = feats[a] - feats[b]
        else:
            b, t = -1, (s + to[i]) % k
            delta = feats[a]
        ds, dt = dev[s] - delta, dev[t] + delta
        new = cost - float(dev[s] @ dev[s] + dev[t] @ dev[t]) + float(ds @ ds + dt @ dt)
        cool = heat * (1 - i / steps) + 1e-15
        if new <= cost or luck[i] < np.exp(-(new - cost) / cool):
            dev[s], dev[t], cost = ds, dt, new
            split[a] = t
            if b >= 0:
                split[b] = s
            if cost < best_cost - 1e-15:
                best, best_cost = split.copy(), cost
    return best


def _worker(deviation: np.ndarray, share: float, scale: np.ndarray, seed: int, temperature: float):
    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        s = _anneal(pdf, deviation, share, scale, seed + int(pdf["shard"].iloc[0]), temperature)
        return pdf.assign(split=s)[["group_id", "size", "labels", "split"]]

    return work


def assign_splits(
    groups: DataFrame, key: str, label: str | None = None, splits: Sequence[tuple[str, float]] = SPLITS, rounds: int = 4, seed: int = 17
) -> DataFrame:
    """groups (key, group_id, label) -> (key, group_id, split)."""
    names, shares = [s for s, _ in splits], np.array([p for _, p in splits], float)
    shares = shares / shares.sum()
    if label is None:
        groups, label = groups.withColumn("__label", F.lit("")), "__label"
    said = F.coalesce(F.col(label).cast("string"), F.lit(""))
    kinds = [r[0] for r in groups.groupBy(said.alias("l")).count().orderBy(F.desc("count"), "l").limit(LABELS + 1).select("l").collect()]
    n_labels = max(1, len(kinds)) if len(kinds) <= LABELS else LABELS + REST
    place = F.array_position(F.array(*map(F.lit, kinds[:LABELS] or [""])), said).cast("int") - 1
    rest = F.pmod(F.xxhash64(said), F.lit(REST)).cast("int") + LABELS
    groups = groups.withColumn("__bucket", F.when(place >= 0, place).otherwise(rest))
    counts = groups.groupBy("group_id").agg(
        F.count("*").alias("size"), F.array(*[F.count_if(F.col("__bucket") == i) for i in range(n_labels)]).alias("labels")
    )
    u = F.pmod(F.xxhash64("group_id", F.lit(seed)), F.lit(1_000_000)) / 1_000_000
    start = sum((F.when(u >= float(c), 1).otherwise(0) for c in np.cumsum(shares)[:-1]), F.lit(0))
    comp = materialize(counts.withColumn("split", start.cast("int")))
    k = len(names)

    def totals(d: DataFrame) -> np.ndarray:
        out = np.zeros((k, 1 + n_labels))
        for r in d.groupBy("split").agg(F.sum("size"), *[F.sum(F.col("labels")[i]) for i in range(n_labels)]).collect():
            out[r[0]] = [float(x) for x in r[1:]]
        return out

    now = totals(comp)
    whole, n_comp = now.sum(axis=0), comp.count()
    if n_comp:
        want, scale = np.outer(shares, whole), np.maximum(whole, 1)
        loss = lambda t: float((((t - want) / scale) ** 2).sum())
        shards = -(-n_comp // SHARD)
        best, best_loss = comp, loss(now)
        for r in range(rounds):
            work = _worker((now - want), 1 / shards, scale, seed + 1000 * r, 0.5**r)
            mixed = comp.withColumn("shard", F.pmod(F.xxhash64("group_id", F.lit(seed + r)), F.lit(shards)).cast("int"))
            comp = materialize(mixed.groupBy("shard").applyInPandas(work, "group_id string, size bigint, labels array<bigint>, split int"))
            now = totals(comp)
            if loss(now) < best_loss:
                best, best_loss = comp, loss(now)
            else:
                break
        comp = best
    name = F.element_at(F.array(*[F.lit(x) for x in names]), F.col("split") + 1)
    return groups.join(comp.select("group_id", name.alias("split")), "group_id").select(key, "group_id", "split")


def balance(assigned: DataFrame, label: str, splits: Sequence[tuple[str, float]] = SPLITS) -> DataFrame:
    """assigned (key, group_id, split, label) -> one row per split: records, share, target, largest_group (its share of all
    records), label_deviation (half the sum over labels of what the split's shares differ from those of all records), and within:
    whether the share is off its target by no more than 0.01 or the largest group. The groups' sizes and the labels' counts are
    aggregated; one row per split and label reaches the last step."""
    n = assigned.count()
    groups = assigned.groupBy("split", "group_id").count().groupBy("split").agg(F.sum("count").alias("records"), F.max("count").alias("m"))
    said = F.coalesce(F.col(label).cast("string"), F.lit("")).alias("l")
    per = assigned.groupBy("split", said).count()
    every = per.groupBy("l").agg((F.sum("count") / max(1, n)).alias("p"))
    size = groups.select("split", "records")
    # every label counts in every split, also where a split has none of it
    grid = every.join(per.groupBy("l").pivot("split", [s for s, _ in splits]).agg(F.sum("count")), "l")
    cells = grid.select("p", F.explode(F.array(*[F.struct(F.lit(s).alias("split"), F.coalesce(F.col(s), F.lit(0)).alias("c")) for s, _ in splits])).alias("x")).select("p", "x.split", "x.c")
    off = cells.join(size, "split").groupBy("split").agg(F.round(F.sum(F.abs(F.col("c") / F.col("records") - F.col("p"))) / 2, 4).alias("label_deviation"))
    total = sum(p for _, p in splits)
    target = F.element_at(F.create_map(*[x for s, p in splits for x in (F.lit(s), F.lit(p / total))]), F.col("split"))
    largest = groups.agg(F.max("m")).first()[0] or 0
    share = F.col("records") / max(1, n)
    return groups.join(off, "split").select(
        "split", "records", F.round(share, 4).alias("share"), target.alias("target"), F.round(F.lit(largest / max(1, n)), 4).alias("largest_group"),
        "label_deviation", (F.abs(share - target) <= max(0.01, largest / max(1, n))).alias("within"),
    )
