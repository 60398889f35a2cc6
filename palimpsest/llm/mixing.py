"""Problem 9: mixing sources to target weights.

Method: every source's tokens are packed into blocks of a fixed length; each output shard draws its numbers of blocks per source
from a multinomial, conditioned on the totals that meet the targets exactly; its slots are mapped through a pseudorandom
permutation of the source's block indices (a Feistel network per source and epoch), and slots and blocks are joined by index.

Sources are packed in buckets of about BUCKET characters, so a source that holds a third of all rows is many tasks; the last
block of a bucket may be shorter, and counts with its true size in the shares reached. Every document of a source with a target
is packed, and a block is drawn at most max_repeats times.

Defined results: null and empty texts have no tokens; documents of a source without a target (or with weight 0 or null) stay
out; a target without documents is reported with an actual share of 0 while the others keep their proportions; null
max_repeats means 1; repeated documents count once; empty tables give an empty mixture.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.llm.bpe import VOCABULARY, encoder_of, shared_vocabulary
from palimpsest.llm.shingles import mix
from palimpsest.session import materialize

BLOCK, SHARD_SLOTS, BUCKET = 256, 1024, 4_000_000


def pack(docs: DataFrame, key: str, text: str, source: str, block: int = BLOCK, vocabulary: str = VOCABULARY) -> DataFrame:
    """(source, bucket, k, n, ids): the blocks of every source; documents follow each other by hash and key."""
    shared = shared_vocabulary(docs, vocabulary)

    def work(keys: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        enc, flat = encoder_of(shared.value), []
        rows = rows.sort_by([("h", "ascending"), ("key", "ascending")])
        for t in rows["text"].to_pylist():
            if t:
                flat.append(np.frombuffer(enc.encode(t), np.int32))
        ids = np.concatenate(flat) if flat else np.empty(0, np.int32)
        n = -(-len(ids) // block)
        ends = np.minimum(np.arange(n + 1) * block, len(ids)).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))
        return pa.table(
            {"source": pa.array([keys[0].as_py()] * n, pa.string()), "bucket": pa.array([keys[1].as_py()] * n, pa.int64()), "k": pa.array(np.arange(n)), "n": pa.array(np.diff(ends)), "ids": lists}
        )

    sizes = docs.groupBy(source).agg(F.greatest(F.ceil(F.sum(F.length(text)) / BUCKET), F.lit(1)).alias("__buckets"))
    rows = docs.join(F.broadcast(sizes) if sizes.count() <= 10_000 else sizes, source)
    rows = rows.select(
        F.col(source).alias("source"), F.pmod(F.xxhash64(key), F.col("__buckets")).alias("bucket"),
        F.xxhash64(F.lit(7), key).alias("h"), F.col(key).cast("string").alias("key"), F.col(text).alias("text"),
    )
    return rows.groupBy("source", "bucket").applyInArrow(work, "source string, bucket bigint, k bigint, n int, ids array<int>")


def permuted(i: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """The place of i in a pseudorandom permutation of range(n), chosen by key: Feistel rounds, walked until inside."""
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(n, 2))) + 1).astype(np.int64) // 2).astype(np.uint64)
    low = (np.uint64(1) << half) - np.uint64(1)
    out, todo = i.astype(np.uint64), np.ones(len(i), bool)
    while todo.any():
        x, h, m, k = out[todo], half[todo], low[todo], key[todo]
        a, b = x >> h, x & m
        for r in range(4):
            a, b = b, a ^ (mix(b + k + np.uint64(0x9E3779B97F4A7C15 * (r + 1) & (1 << 64) - 1)) & m)
        out[todo] = a << h | b
        todo = out >= n.astype(np.uint64)
    return out.astype(np.int64)


def shard_counts(shard: int, shards: int, slots: int, totals: np.ndarray, per_shard: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(counts per source of a shard, drawn before it): descends a binary tree of shards, splitting the totals at each node at
    random, so that every shard finds its own part without the others, and all parts sum up to the totals."""
    lo, hi, counts, before = 0, shards, totals.copy(), np.zeros_like(totals)
    while hi - lo > 1:
        mid = (lo + hi) // 2
        n, left = int(counts.sum()), (mid - lo) * per_shard
        rng = np.random.default_rng((seed, lo, hi))
        part, need = np.zeros_like(counts), min(left, n)
        for s in range(len(counts)):  # multivariate hypergeometric, one source after another
            rest = int(counts[s + 1 :].sum())
            # beyond the generator's range the draw is replaced by its normal limit
            if counts[s] + rest >= 10**9:
                p = counts[s] / max(1, counts[s] + rest)
                x = int(np.clip(round(rng.normal(need * p, (need * p * (1 - p)) ** 0.5)), max(0, need - rest), min(counts[s], need)))
            else:
                x = int(rng.hypergeometric(int(counts[s]), rest, need)) if need else 0
            part[s], need = x, need - x
        if shard < mid:
            hi, counts = mid, part
        else:
            lo, before, counts = mid, before + part, counts - part
    return counts, before


def plan(sizes: list[tuple[str, int, int]], targets: dict[str, tuple[float, int]]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """sizes (source, blocks, tokens), targets source -> (weight, max_repeats) -> (sources, blocks of each, draws of each).

    As many draws as the caps allow: a source's tokens are its draws times its mean block.
    """
    have = sorted((s, b, t) for s, b, t in sizes if b and (targets.get(s, (0, 1))[0] or 0) > 0)
    names, blocks = [s for s, _, _ in have], np.array([b for _, b, _ in have], np.int64)
    if not names:
        return [], blocks, blocks
    mean = np.array([t / b for _, b, t in have])
    weight = np.array([targets[s][0] for s in names], float)
    caps = blocks * np.array([max(1, targets[s][1] if targets[s][1] is not None else 1) for s in names], np.int64)
    tokens = (caps * mean / weight).min() * weight
    return names, blocks, np.minimum(caps, np.round(tokens / mean).astype(np.int64))


def mixture(
    docs: DataFrame, targets: DataFrame, key: str, text: str, source: str, block: int = BLOCK, vocabulary: str = VOCABULARY, seed: int = 29
) -> tuple[DataFrame, DataFrame]:
    """(mixture, shares): mixture (shard, slot, source, repeat, block, n_tokens, ids), one row per drawn block; shares (source,
    target_weight, max_repeats, blocks, tokens, drawn_blocks, most_repeats, drawn_tokens, actual_share), one row per target.

    targets (source, target_weight, max_repeats): a table of the sources, small by nature; it and the counts per source are
    what the driver sees."""
    wanted = {r[0]: (r[1], r[2]) for r in targets.where("source is not null").select("source", "target_weight", "max_repeats").collect()}
    aimed = docs.where(F.col(source).isin(*[s for s, (w, _) in wanted.items() if (w or 0) > 0])) if wanted else docs.where("false")
    packed = materialize(pack(aimed, key, text, source, block, vocabulary))
    per_bucket = packed.groupBy("source", "bucket").agg(F.count("*").alias("b"), F.sum("n").alias("t"))
    per_bucket = materialize(per_bucket)
    w = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_bucket.select("source", "bucket", F.coalesce(F.sum("b").over(w), F.lit(0)).alias("start"))
    blocks = packed.join(starts, ["source", "bucket"]).select("source", (F.col("start") + F.col("k")).alias("block"), F.col("n").alias("n_tokens"), "ids")
    sizes = [tuple(r) for r in per_bucket.groupBy("source").agg(F.sum("b"), F.sum("t")).collect()]
    names, n_blocks, draws = plan(sizes, wanted)
    slots = int(draws.sum()) if names else 0
    shards = -(-slots // SHARD_SLOTS)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch["id"].to_pylist():
                counts, before = shard_counts(shard, shards, slots, draws, SHARD_SLOTS, seed)
                which = np.repeat(np.arange(len(names)), counts)
                nth = np.concatenate([np.arange(b, b + c) for b, c in zip(before, counts, strict=True)])
                size = n_blocks[which]
                epoch = nth // size
                k = mix((which * 1_000_003 + epoch + seed).astype(np.uint64))
                at = permuted(nth % size, size, k)
                order = np.random.default_rng((seed, 1, shard)).permutation(len(which))
                yield pa.RecordBatch.from_pydict(
                    {
                        "shard": pa.array(np.full(len(which), shard)), "slot": pa.array(np.arange(len(which))),
                        "source": pa.array([names[i] for i in which[order]], pa.string()),
                        "repeat": pa.array(epoch[order]), "block": pa.array(at[order]),
                    }
                )

    spark = docs.sparkSession
    drawn = spark.range(shards).mapInArrow(fill, "shard bigint, slot bigint, source string, repeat bigint, block bigint")
    # the planner cannot see how many slots a shard makes, so it must not broadcast them
    out = drawn.hint("merge").join(blocks, ["source", "block"]).select("shard", "slot", "source", "repeat", "block", "n_tokens", "ids")
    light = drawn.hint("merge").join(blocks.select("source", "block", "n_tokens"), ["source", "block"])
    got = light.groupBy("source").agg(F.count("*").alias("drawn_blocks"), F.max("repeat").alias("r"), F.sum("n_tokens").alias("drawn_tokens"))
    had = per_bucket.groupBy("source").agg(F.sum("b").alias("blocks"), F.sum("t").alias("tokens"))
    zero = F.lit(0)
    shares = targets.where("source is not null").join(had, "source", "left").join(got, "source", "left").select(
        "source", "target_weight", "max_repeats", *[F.coalesce(c, zero).alias(c) for c in ("blocks", "tokens", "drawn_blocks")],
        F.coalesce(F.col("r") + 1, zero).alias("most_repeats"), F.coalesce("drawn_tokens", zero).alias("drawn_tokens"),
    )
    total = F.sum("drawn_tokens").over(Window.partitionBy())
    return out, shares.withColumn("actual_share", F.round(F.coalesce(F.col("drawn_tokens") / F.nullif(total, zero), F.lit(0.0)), 6))
