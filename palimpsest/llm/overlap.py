"""Problem 5: same or near-same records across splits.

Method: the word runs of the evaluation texts are hashed and partitioned by hash, the training texts are scanned once for hits,
and the containment of each evaluation text in each training text it meets is computed: the share of its runs that the training
text has. So an evaluation text that stands whole within a much longer training text is found, whatever their similarity.

A training text that has a share c of an evaluation text's n runs has k at least of any n - ceil(c n) + k of them, so only so many
runs of each evaluation text are looked for, and pairs with fewer than k hits are no candidates: nothing is lost. Looked for
are the runs that the fewest training texts have, by a sketch of fixed size that counts them first. A bitmap of fixed size tells
the scan which runs are looked for at all. What is met is verified on whole texts; only texts of candidates are moved.

Equal texts take part once. Defined results: null, empty and short texts (fewer than RUN words) overlap with nothing; repeated
deliveries count once (with a rank, the greatest alone); empty tables give no rows.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.llm.shingles import distinct_runs
from palimpsest.session import materialize, release, spread

#: Sizes of what is broadcast, whatever the data: counters of the sketch (one byte each then), and bits of the bitmap.
SKETCH, BITS, CHUNK = 1 << 20, 1 << 24, 1 << 12
#: Parts that are folded at once.
FAN = 64
#: Hits that make a candidate (all that may be asked for, where a text has fewer runs).
HITS = 4


def _merge(df: DataFrame, tasks: int, fold, size: int, dtype) -> np.ndarray:
    """Partial arrays (task, chunk, part) of all tasks, folded chunk by chunk in a tree whose every node has FAN parts at most;
    size entries reach the driver."""
    schema = "task int, chunk int, part binary"

    def work(keys: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        parts = [np.frombuffer(zlib.decompress(x), dtype) for x in rows["part"].to_pylist()]
        one = zlib.compress(fold.reduce(parts).tobytes(), 1)
        return pa.table({"task": pa.array([keys[0].as_py()], pa.int32()), "chunk": pa.array([keys[1].as_py()], pa.int32()), "part": pa.array([one], pa.binary())})

    while tasks > 1:
        df, tasks = df.withColumn("task", F.floor(F.col("task") / FAN).cast("int")).groupBy("task", "chunk").applyInArrow(work, schema), -(-tasks // FAN)
    out = np.zeros(size, dtype)
    for _, chunk, part in df.collect():
        at = slice(chunk * CHUNK, (chunk + 1) * CHUNK)
        out[at] = fold(out[at], np.frombuffer(zlib.decompress(bytes(part)), dtype))
    return out


def _chunks(whole: np.ndarray) -> Iterator[pa.RecordBatch]:
    used = [i for i in range(len(whole) // CHUNK) if whole[i * CHUNK : (i + 1) * CHUNK].any()]
    parts = [zlib.compress(whole[i * CHUNK : (i + 1) * CHUNK].tobytes(), 1) for i in used]
    task = np.full(len(used), TaskContext.get().partitionId(), np.int32)
    yield pa.RecordBatch.from_arrays([pa.array(task), pa.array(used, pa.int32()), pa.array(parts, pa.binary())], ["task", "chunk", "part"])


class _Seen(set):
    """Ids met in a task; emptied when there are too many to hold, so a text may then be met again."""

    def new(self, i: int) -> bool:
        if i in self:
            return False
        if len(self) > 500_000:
            self.clear()
        self.add(i)
        return True


def _texts(batch: pa.RecordBatch, seen: _Seen) -> Iterator[tuple[int, np.ndarray]]:
    ids = batch["id"].to_pylist()
    for k, i in enumerate(ids):
        if seen.new(i):
            yield i, distinct_runs(batch["text"][k].as_py())


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sketch, seen = np.zeros(SKETCH, np.int64), _Seen()
    for batch in batches:
        for _, r in _texts(batch, seen):
            sketch[(r >> np.uint64(44)).astype(np.int64)] += 1
    yield from _chunks(sketch)


def _rows(found: list[tuple[int, np.ndarray, int]]) -> pa.RecordBatch:
    """(id, run, size) of (id, runs, size)."""
    empty = [np.empty(0, np.int64)] * 2 + [np.empty(0, np.int32)]
    cols = list(zip(*((np.full(len(r), i), r.view(np.int64), np.full(len(r), n, np.int32)) for i, r, n in found), strict=True)) if found else [[x] for x in empty]
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in cols], ["id", "run", "size"])


def _looked_for(containment: float, commonness):
    """Evaluation texts (id, text) -> (id, run, size): the runs that are looked for, of size in all."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, seen = commonness.value, _Seen()
        for batch in batches:
            found = []
            for i, r in _texts(batch, seen):
                if n := len(r):
                    order = np.argsort(common[(r >> np.uint64(44)).astype(np.int64)], kind="stable")
                    found.append((i, r[order[: n - math.ceil(containment * n - 1e-9) + HITS]], n))
            yield _rows(found)

    return work


def _hits(bitmap):
    """Training texts (id, text) -> (id, run, size): those of their runs that are looked for."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, seen = bitmap.value, _Seen()
        for batch in batches:
            found = []
            for i, r in _texts(batch, seen):
                at = (r & np.uint64(BITS - 1)).astype(np.int64)
                found.append((i, r[bits[at >> 3] >> (at & 7).astype(np.uint8) & 1 == 1], len(r)))
            yield _rows(found)

    return work


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bits = np.zeros(BITS // 8, np.uint8)
    for batch in batches:
        at = batch["run"].to_numpy(zero_copy_only=False).view(np.uint64) & np.uint64(BITS - 1)
        at = at.astype(np.int64)
        np.bitwise_or.at(bits, at >> 3, (np.uint8(1) << (at & 7).astype(np.uint8)))
    yield from _chunks(bits)


def _contain(containment: float):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}

        def runs(i: int, text: str) -> np.ndarray:
            if i not in known:
                if len(known) > 2000:
                    known.clear()
                known[i] = distinct_runs(text)
            return known[i]

        for batch in batches:
            rows = []
            for e, t, te, tt in zip(*(batch[c].to_pylist() for c in ("e", "t", "text_e", "text_t")), strict=True):
                a, b = runs(e, te), runs(t, tt)
                both = len(np.intersect1d(a, b, assume_unique=True))
                if both >= containment * len(a) - 1e-9:
                    rows.append((e, t, both / len(a), both / (len(a) + len(b) - both)))
            cols = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.float64()), pa.array(cols[3], pa.float64())],
                ["e", "t", "containment", "similarity"],
            )

    return work


def overlaps(evaluation: DataFrame, training: DataFrame, containment: float = 0.8) -> DataFrame:
    """evaluation (key_e, text), training (key_t, text), any number of texts a key -> (key_e, key_t, containment, similarity).

    One row per pair of keys of which an evaluation text has at least that share of its runs in a training text, with the best
    values of its texts. As similarity is at most containment, whoever wants pairs of a similarity asks for that containment and
    filters. With a column rank only those texts of a key count that have its greatest rank.
    """

    def sides(df: DataFrame, key: str, name: str):
        # equal texts share an id of 64 bits; n unlike texts have a chance of n^2 / 2^65 that two of them share one
        rows = df.withColumn("id", F.when(F.col("text") != "", F.xxhash64("text", F.length("text"))))
        keys = rows.select(key, "id", *[c for c in ["rank"] if c in df.columns])
        if "rank" in df.columns:
            keys = keys.groupBy(key, "rank").agg(F.collect_set("id").alias("ids")).groupBy(key).agg(F.max_by("ids", "rank").alias("ids"))
            keys = keys.select(key, F.explode("ids").alias("id"))
        return keys.where("id is not null").distinct().withColumnRenamed("id", name), spread(rows.where("id is not null").select("id", "text"))

    keys_e, texts_e = sides(evaluation, "key_e", "e")
    keys_t, texts_t = sides(training, "key_t", "t")
    share = evaluation.sparkSession.sparkContext.broadcast
    parts, schema = "task int, chunk int, part binary", "id bigint, run bigint, size int"
    counts = _merge(texts_t.mapInArrow(_count, parts), texts_t.rdd.getNumPartitions(), np.add, SKETCH, np.int64)
    # powers of two above the mean load of a counter: what is not clearly common is ordered by hash
    level = np.log2(np.maximum(counts / max(1.0, float(counts.mean())), 1) + 1e-9)
    commonness = share(np.clip(level * 2, 0, 255).astype(np.uint8))
    wanted = materialize(texts_e.mapInArrow(_looked_for(containment, commonness), schema))
    bitmap = share(_merge(wanted.select("run").mapInArrow(_mark, parts), wanted.rdd.getNumPartitions(), np.bitwise_or, BITS // 8, np.uint8))
    # equal texts of unlike tasks are met more than once; both sides are spread by run and made distinct there
    distinct = lambda df, name: df.select(F.col("id").alias(name), "run", F.col("size").alias(f"s{name}")).repartition("run").dropDuplicates(["run", name])
    hits = distinct(wanted, "e").join(distinct(texts_t.mapInArrow(_hits(bitmap), schema), "t"), "run")
    met = hits.groupBy("e", "t").agg(F.count("*").alias("n"), F.first("se").alias("se"))
    met = materialize(met.where(f"n >= least(ceil({containment} * se - 1e-9), {HITS})").select("e", "t"))

    def of(texts: DataFrame, name: str) -> DataFrame:
        """The texts of the candidates, each once."""
        some = texts.withColumnRenamed("id", name).join(met.select(name).distinct(), name, "left_semi")
        return some.groupBy(name).agg(F.min("text").alias(f"text_{name}"))

    full = met.join(of(texts_e, "e"), "e").join(of(texts_t, "t"), "t")
    pairs = materialize(full.mapInArrow(_contain(containment), "e bigint, t bigint, containment double, similarity double"))
    release(wanted)
    release(met)
    return (
        pairs.hint("merge").join(keys_e, "e").join(keys_t, "t").groupBy("key_e", "key_t")
        .agg(F.max("containment").alias("containment"), F.max("similarity").alias("similarity"))
    )
