"""Near-duplicate clusters by MinHash: runs of words, signatures, bands, verified pairs, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.functions.runs import distinct_runs, jaccard
from palimpsest.operators.components import connected_components
from palimpsest.session import materialize, release, spread

#: Bands of so many rows each: of pairs of similarity 0.8 one in 20 million meets in no band, of 0.7 one in 7,000.
BANDS, ROWS = 32, 4
PERMUTATIONS = BANDS * ROWS
SIMILARITY = 0.8


def _signature(runs: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least of every permuted hash; texts without runs have one signature of their own."""
    if not len(runs):
        return np.zeros(PERMUTATIONS, np.uint32)
    out = np.full((PERMUTATIONS, 1), (1 << 32) - 1, np.uint32)
    for i in range(0, len(runs), 2048):  # a long text is no large matrix
        h = (a * runs[i : i + 2048] + b) >> np.uint64(32)
        out = np.minimum(out, h.min(axis=1, keepdims=True).astype(np.uint32))
    return out[:, 0]


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rng = np.random.default_rng(1)
    a = rng.integers(1, 2**63, (PERMUTATIONS, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = rng.integers(0, 2**63, (PERMUTATIONS, 1), dtype=np.uint64)
    for batch in batches:
        kinds, bands = [], []
        for t in batch["text"].to_pylist():
            runs = distinct_runs(t, short=True)
            kinds.append(xxhash.xxh3_128_hexdigest(runs.tobytes()))
            sig = _signature(runs, a, b)
            bands.append([int.from_bytes(xxhash.xxh64_digest(sig[i * ROWS : (i + 1) * ROWS].tobytes(), seed=i), "little", signed=True) for i in range(BANDS)])
        yield pa.RecordBatch.from_arrays([batch["key"], pa.array(kinds, pa.string()), pa.array(bands, pa.list_(pa.int64()))], ["key", "kind", "bands"])


def _verified(least: float):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}

        def runs(k, text: str | None) -> np.ndarray:
            if k not in known:
                if len(known) > 2000:
                    known.clear()
                known[k] = distinct_runs(text, short=True)
            return known[k]

        for batch in batches:
            keep = [jaccard(runs(a, x), runs(b, y)) >= least - 1e-12 for a, b, x, y in zip(*(batch[c].to_pylist() for c in ("a", "b", "text_a", "text_b")), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return work


def clusters(df: DataFrame, key: str, text: str, similarity: float = SIMILARITY) -> DataFrame:
    """(key, cluster, is_canonical): texts whose distinct runs of five words (after the frontmatter; single words of shorter texts)
    are similar to that degree belong together, directly or through others; the canonical one and the cluster's name is the
    smallest key. Texts without words share a cluster.

    Texts of equal runs are one, so that a third of all rows may be copies of one text; pairs come from bands and are verified.
    """
    kind = dict(df.dtypes)[key]
    texts = df.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.col(text).alias("text"))
    signed = materialize(spread(texts).mapInArrow(_sign, f"key {kind}, kind string, bands array<bigint>"))
    one = signed.groupBy("kind").agg(F.min("key").alias("rep"))
    members = materialize(signed.join(one, "kind").select("key", "rep"))
    own = signed.join(members.where("key = rep").select("key"), "key", "left_semi")
    slots = own.select("key", F.explode("bands").alias("bucket"))
    met = slots.withColumnRenamed("key", "a").join(slots.withColumnRenamed("key", "b"), "bucket").where("a < b").select("a", "b").distinct()
    of = lambda side: texts.select(F.col("key").alias(side), F.col("text").alias(f"text_{side}"))
    full = met.join(of("a"), "a").join(of("b"), "b")
    pairs = materialize(full.mapInArrow(_verified(similarity), f"a {kind}, b {kind}"))
    comp = connected_components(pairs, "a", "b")
    release(signed)
    out = members.join(comp.withColumnRenamed("node", "rep"), "rep", "left").select("key", F.coalesce("component", "rep").alias("cluster"))
    return out.select(F.col("key").alias(key), "cluster", (F.col("key") == F.col("cluster")).alias("is_canonical"))


def cluster_stats(members: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Clusters, those with one member, those with more, and the members of these."""
    size = members.groupBy(cluster).count()
    return size.agg(
        F.count("*").alias("clusters"), F.count_if(F.col("count") == 1).alias("singletons"), F.count_if(F.col("count") > 1).alias("multi"),
        F.coalesce(F.sum(F.when(F.col("count") > 1, F.col("count"))), F.lit(0)).alias("covered"),
    )


def _run_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = [len(distinct_runs(t, short=True)) for t in batch["text"].to_pylist()]
        yield pa.RecordBatch.from_arrays([batch["key"], pa.array(n, pa.int32())], ["key", "runs"])


def run_counts(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, runs): how many distinct runs the clusters' comparison sees in every text."""
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return spread(rows).mapInArrow(_run_counts, f"key {dict(df.dtypes)[key]}, runs int").withColumnRenamed("key", key)
