"""Problem 4: near-duplicate records with small edits.

Method: BagMinHash. Every (run of words, multiplicity) starts hierarchical Poisson processes over the discretised weights
[0, 1), [1, 2), [2, 4), [4, 8), ...; a point counts if its level lies below the multiplicity, so each of the M registers keeps
the earliest point of a bag and two bags agree in a register with their weighted Jaccard similarity as probability. Points are
drawn in order of time and a process ends when it is later than every register, so large bags cost little more than reading
them. Signatures are cut into bands; texts that meet in a band are candidates, those whose signatures differ too much are
left out, the rest is verified by the exact overlap of the (multi)sets of runs.

Texts with equal runs form one class, which takes part once; hot buckets are joined, not collected, so AQE may split them.

Defined results: null, empty and short texts (fewer than RUN words) have no runs and are similar to nothing; equal texts of
enough words are similar; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.llm.shingles import body_words, mix, run_hashes
from palimpsest.operators.components import connected_components
from palimpsest.session import materialize, release

BANDS, ROWS = 32, 4
M = BANDS * ROWS
#: Standard errors of the signature's estimate by which a candidate may fall short and still be verified: of pairs on the
#: threshold 3 in 10 million fall short by more. None verifies every candidate.
SLACK = 5.0


_MASK = (1 << 64) - 1


def _unit(h: np.ndarray) -> np.ndarray:
    return ((h >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def bag_signatures(items: np.ndarray, weights: np.ndarray, owner: np.ndarray, n: int, m: int = M) -> np.ndarray:
    """n x m registers, as 32-bit hashes of the point in each; items (uint64) of bag owner[i] have integer weights >= 1.

    A bag without items has the signature of zeros."""
    time = np.full(n * m, np.inf)
    mark = np.zeros(n * m, np.uint64)
    level, lo, hi = 0, 0.0, 1.0
    live = np.arange(len(items))
    while len(live):  # one hierarchy level a turn: [0,1), [1,2), [2,4), ...
        seed = mix(items[live] + np.uint64(0xA0761D6478BD642F * (level + 1) & _MASK))
        own, wt, t = owner[live], weights[live], np.zeros(len(live))
        step = 0
        while len(seed):
            step += 1
            a = mix(seed + np.uint64(0xE7037ED1A0B428DB * step & _MASK))
            t = t - np.log(_unit(a)) / (m * (hi - lo))
            b = mix(a + np.uint64(0x8EBC6AF09C88C6E3))
            where = own * m + (b % np.uint64(m)).astype(np.int64)
            ok = lo + (hi - lo) * _unit(mix(b)) < wt
            np.minimum.at(time, where[ok], t[ok])
            first = ok & (time[where] == t)
            mark[where[first]] = a[first]
            late = time.reshape(n, m).max(axis=1)
            keep = t <= late[own]
            seed, own, wt, t = seed[keep], own[keep], wt[keep], t[keep]
        lo, hi, level = hi, hi * 2, level + 1
        live = live[weights[live] > lo]
    return (mark >> np.uint64(32)).astype(np.uint32).reshape(n, m)


def _bags(texts: list[str | None], counts: bool, least_words: int):
    for t in texts:
        words = body_words(t)
        runs, n = np.unique(run_hashes(words), return_counts=True)
        yield (runs, n if counts else np.ones_like(n)) if len(words) >= least_words else (runs[:0], n[:0])


def _sign(key: str, counts: bool, least_words: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bags = list(_bags(batch["text"].to_pylist(), counts, least_words))
            kept = [i for i, (r, _) in enumerate(bags) if len(r)]
            if not kept:
                continue
            sizes = [len(bags[i][0]) for i in kept]
            items = np.concatenate([bags[i][0] for i in kept])
            weights = np.concatenate([bags[i][1] for i in kept])
            sig = bag_signatures(items, weights, np.repeat(np.arange(len(kept)), sizes), len(kept))
            bands = [[int.from_bytes(xxhash.xxh64_digest(s[i : i + ROWS].tobytes(), seed=i), "little", signed=True) for i in range(0, M, ROWS)] for s in sig]
            classes = [xxhash.xxh3_128_hexdigest(bags[i][0].tobytes() + bags[i][1].astype(np.int64).tobytes()) for i in kept]
            yield pa.RecordBatch.from_pydict(
                {
                    key: batch[key].take(pa.array(kept)),
                    "class": classes,
                    "weight": pa.array([int(bags[i][1].sum()) for i in kept], pa.int64()),
                    "bands": pa.array(bands, pa.list_(pa.int64())),
                    "sig": pa.array([s.astype(np.uint16).tobytes() for s in sig], pa.binary()),
                }
            )

    return work


def signatures(texts: DataFrame, key: str, counts: bool = True, least_words: int = 0) -> DataFrame:
    """texts (key, text) -> (key, class, weight, bands, sig) of the texts that have runs."""
    kind = dict(texts.dtypes)[key]
    schema = f"`{key}` {kind}, class string, weight bigint, bands array<bigint>, sig binary"
    return texts.select(key, "text").mapInArrow(_sign(key, counts, least_words), schema)


def _plausible(threshold: float, slack: float):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        floor = threshold - slack * (threshold * (1 - threshold) / M) ** 0.5
        for batch in batches:
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(batch[c].to_pylist()), np.uint16).reshape(-1, M) for c in ("sig_a", "sig_b"))
                yield batch.filter(pa.array((a == b).mean(axis=1) >= floor)).select(["a", "b"])

    return work


def _verify(threshold: float, counts: bool):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, tuple] = {}

        def bag(k: str, text: str):
            if k not in seen:
                if len(seen) > 2000:
                    seen.clear()
                seen[k] = next(_bags([text], counts, 0))
            return seen[k]

        for batch in batches:
            out = []
            for a, b, ta, tb in zip(*(batch[c].to_pylist() for c in ("a", "b", "text_a", "text_b")), strict=True):
                (ra, na), (rb, nb) = bag(a, ta), bag(b, tb)
                _, ia, ib = np.intersect1d(ra, rb, assume_unique=True, return_indices=True)
                both = int(np.minimum(na[ia], nb[ib]).sum())
                out.append(both / max(1, int(na.sum() + nb.sum()) - both))
            s = np.array(out)
            keep = pa.array(s >= threshold) if len(s) else pa.array([], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"], pa.array(s, pa.float64())], ["a", "b", "similarity"]).filter(keep)

    return work


def similar_pairs(
    texts: DataFrame, key: str, threshold: float, counts: bool = True, least_words: int = 0, slack: float | None = SLACK
) -> tuple[DataFrame, DataFrame]:
    """texts (key, text), one row per key, best materialised -> (members, pairs).

    members (key, rep): the class representative (smallest key) of every text with runs. pairs (a, b, similarity): every two
    representatives with a < b whose similarity reaches the threshold. counts: whether runs count as often as they occur.
    slack: candidates whose signatures fall short of the threshold by more standard errors are not verified; None verifies all.
    """
    signed = materialize(signatures(texts, key, counts, least_words))
    reps = signed.groupBy("class").agg(F.min(key).alias("rep"))
    members = materialize(signed.join(reps, "class").select(key, "rep"))
    own = signed.join(members.where(F.col(key) == F.col("rep")).select(key), key, "left_semi")
    own = materialize(own.select(F.col(key).alias("id"), "weight", "bands", "sig"))
    slots = own.select("id", "weight", F.explode("bands").alias("bucket"))
    left, right = (slots.select("bucket", F.col("id").alias(x), F.col("weight").alias(f"w{x}")) for x in "ab")
    # the similarity of two bags is at most the quotient of their weights
    sized = f"wa >= {threshold - 1e-9} * wb and wb >= {threshold - 1e-9} * wa"
    met = left.join(right, "bucket").where(f"a < b and {sized}").select("a", "b").distinct()
    kind = dict(texts.dtypes)[key]
    if slack is not None:
        sig = own.select("id", "sig")
        both = met.join(sig.select(F.col("id").alias("a"), F.col("sig").alias("sig_a")), "a").join(
            sig.select(F.col("id").alias("b"), F.col("sig").alias("sig_b")), "b"
        )
        met = both.mapInArrow(_plausible(threshold, slack), f"a {kind}, b {kind}")
    likely = materialize(met)
    release(own)
    release(signed)
    text = texts.select(F.col(key).alias("id"), "text")
    full = likely.join(text.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a").join(
        text.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b"
    )
    pairs = full.mapInArrow(_verify(threshold, counts), f"a {kind}, b {kind}, similarity double")
    return members, pairs


def member_pairs(members: DataFrame, pairs: DataFrame, key: str) -> DataFrame:
    """(key_a, key_b), smaller key first: all pairs of texts of one class or of two similar classes, so n equal texts give n^2 / 2
    rows; who needs no such pairs takes members and pairs as they are, or groups()."""
    m = materialize(members)
    of = lambda side: m.select(F.col(key).alias(f"k{side}"), F.col("rep").alias(side))
    within = of("a").join(of("b"), F.col("a") == F.col("b")).where("ka < kb").select("ka", "kb")
    across = pairs.join(of("a"), "a").join(of("b"), "b").select(F.least("ka", "kb").alias("ka"), F.greatest("ka", "kb").alias("kb"))
    return within.unionByName(across).select(F.col("ka").alias(f"{key}_a"), F.col("kb").alias(f"{key}_b"))


def groups(members: DataFrame, pairs: DataFrame, key: str) -> DataFrame:
    """(key, group_id, links): the smallest key reachable over similar texts, and with how many classes a text's own is linked."""
    pairs = materialize(pairs)
    comp = connected_components(pairs, "a", "b")
    links = pairs.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count("*").alias("links"))
    out = members.join(comp.withColumnRenamed("node", "rep"), "rep", "left").join(links, "rep", "left")
    return out.select(key, F.coalesce("component", "rep").alias("group_id"), F.coalesce("links", F.lit(0)).alias("links"))
