"""Problem 10: reading level of each document.

Method: a Rasch-style latent difficulty model. A document d has a level t_d, a word w a difficulty b_w and a discrimination a_w; an
occurrence in d is of w with probability sigma(a_w (t_d - b_w)), every occurrence being a trial for every word. Demanding words
have a positive discrimination, plain ones a negative one, words of all texts none. Both sides are estimated by distributed
alternating optimisation of the marginal likelihood: given the words, every document's level is a distribution over NODES, found
on its own; given these, each word's curve is fitted by Newton steps on its own likelihood, from its occurrences and all trials per
node. Rounds end when the likelihood grows no more. Documents with a reader's judgement are anchors: their level is held while
words are fitted, which fixes the scale. Afterwards they are placed like all others, and the bands' limits are where they part
the anchors best.

Only prose counts: frontmatter, fenced and inline code, headings, tables, links' targets and paths are left out; list items are
read as prose. Words are slots of a hash table whose size follows the vocabulary up to MOST, so what is broadcast is bounded.

Defined results: null texts and texts without prose have a null level and band; documents of any language get a level by the
words that they share with others; without any judgement the bands are null; repeated documents count once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.session import materialize, release

#: Slots for words: four times as many as there are words, within these bounds.
LEAST, MOST = 1 << 17, 1 << 20
#: Levels at which documents are held while words are fitted; those of anchors are among them, and finer ones for the result.
NODES = np.linspace(-2, 2, 9)
FINE = np.linspace(-2, 2, 161)
BANDS = {"basic": -1.5, "middle": 0.0, "advanced": 1.5}
#: Rounds at most; the gain of the log-likelihood per occurrence that asks for another; Newton steps per round.
ROUNDS, GAIN, STEPS = 12, 1e-4, 6
#: Precision of the normal prior of discriminations, and spread of the one of levels.
SHRINK, SPREAD = 4.0, 1.0

_FRONT = re.compile(r"\A﻿?---[ \t]*\r?\n.*?^---[ \t]*\r?$", re.S | re.M)
_FENCE = re.compile(r"^[ \t]*(`{3,}|~{3,})[^\n]*\n.*?(?:^[ \t]*\1[`~]*[ \t]*\r?$|\Z)", re.S | re.M)
_DROP = re.compile(r"``[^`]+``|`[^`\n]*`|^[ \t]*#{1,6}[ \t][^\n]*|^[ \t]*\|[^\n]*|^ {4,}\S[^\n]*|<[^<>\n]*>|https?://\S+|(?<![^\s`>])[^\s/_\\@=`<]*[/_\\@=]\S*", re.M)
_TARGET = re.compile(r"\]\([^)\n]*\)")
_WORD = re.compile(r"[^\W\d_]{2,}(?:['’][^\W\d_]+)?|[^\W\d_]")


def prose(text: str | None) -> str:
    """The running text of a Markdown document."""
    if not text:
        return ""
    return _DROP.sub(" ", _TARGET.sub("] ", _FENCE.sub("\n", _FRONT.sub("", text, count=1))))


class _Words(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > 300_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word) & 0x7FFFFFFF
        return h


_words = _Words()


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        flat, ends = [], [0]
        for t in batch["text"].to_pylist():
            words = set(_WORD.findall(prose(t).lower()))
            flat.append(np.fromiter((_words[w] for w in words), np.int32, len(words)))
            ends.append(ends[-1] + len(words))
        values = np.concatenate(flat) if flat else np.empty(0, np.int32)
        lists = pa.ListArray.from_arrays(pa.array(np.array(ends, np.int32)), pa.array(values))
        yield pa.RecordBatch.from_arrays([batch["id"], batch["band"], lists], ["id", "band", "words"])


def _flat(batch: pa.RecordBatch, slots: int) -> tuple[np.ndarray, np.ndarray, int]:
    lists = batch["words"]
    sizes = np.diff(lists.offsets.to_numpy())
    return lists.flatten().to_numpy() & (slots - 1), np.repeat(np.arange(len(sizes)), sizes), len(sizes)


class Curves(NamedTuple):
    """The words' curves: an occurrence at level t is of slot w with log odds tilt[w] t + base[w]."""

    tilt: np.ndarray
    base: np.ndarray

    def none(self, nodes: np.ndarray) -> np.ndarray:
        """Log-likelihood, per node, of an occurrence being of no word; what a word that it is of adds are its log odds."""
        return np.array([-np.logaddexp(0, self.tilt * t + self.base).sum(dtype=np.float64) for t in nodes])


def posterior(curves: Curves, none: np.ndarray, nodes: np.ndarray, slot: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Every document's distribution over the nodes, and its marginal log-likelihood."""
    count = np.bincount(doc, minlength=n)
    tilt, base = np.bincount(doc, curves.tilt[slot], n), np.bincount(doc, curves.base[slot], n)
    prior = -0.5 * (nodes / SPREAD) ** 2
    prior -= np.log(np.exp(prior).sum())
    like = tilt[:, None] * nodes + base[:, None] + count[:, None] * none + prior
    top = like.max(axis=1, keepdims=True)
    p = np.exp(like - top)
    total = p.sum(axis=1, keepdims=True)
    return p / total, (top + np.log(total))[:, 0]


_SUMS = [f"k{i}" for i in range(len(NODES))]


def _expect(state, slots: int, weight: float, anchored_only: bool):
    """Expected occurrences of every slot at every node over a task's documents, anchors counting weight times; slot -1 has the
    trials, slot -2 the log-likelihood of documents that are no anchors and their occurrences."""
    at = {b: int(np.flatnonzero(NODES == t)[0]) for b, t in BANDS.items()}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        curves, none = state.value
        sums, trials, said = np.zeros((len(NODES), slots)), np.zeros(len(NODES)), np.zeros(len(NODES))
        for batch in batches:
            slot, doc, n = _flat(batch, slots)
            if not n:
                continue
            anchor = np.array([at.get(b, -1) for b in batch["band"].to_pylist()])
            free = anchor < 0
            p, like = posterior(curves, none, NODES, slot, doc, n)
            p[~free] = np.eye(len(NODES))[anchor[~free]] * weight
            if anchored_only:
                p[free] = 0
            some = np.bincount(doc, minlength=n)
            said[0] += like[free & (some > 0)].sum()
            said[1] += some[free].sum()
            trials += some @ p
            for k in range(len(NODES)):
                sums[k] += np.bincount(slot, p[doc, k], slots)
        used = np.flatnonzero(sums.sum(axis=0))
        cols = {"slot": pa.array(np.concatenate([[-1, -2], used]), pa.int64())}
        for k, c in enumerate(_SUMS):
            cols[c] = pa.array(np.concatenate([[trials[k], said[k]], sums[k][used]]))
        yield pa.RecordBatch.from_pydict(cols)

    return work


def _newton(trials: np.ndarray):
    """Sums per slot -> (slot, tilt, base): the curve that makes them likeliest, by Newton steps."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            r = np.stack([batch[c].to_numpy() for c in _SUMS])  # nodes x slots
            total = np.maximum(r.sum(axis=0), 1e-9)
            a, c = np.zeros(len(total)), np.log(total / trials.sum())
            for _ in range(STEPS):
                p = 1 / (1 + np.exp(-np.clip(NODES[:, None] * a + c, -40, 40)))
                miss, v = r - trials[:, None] * p, trials[:, None] * p * (1 - p)
                ga, gc = (NODES[:, None] * miss).sum(axis=0) - SHRINK * a, miss.sum(axis=0)
                haa, hac, hcc = (NODES[:, None] ** 2 * v).sum(axis=0) + SHRINK, (NODES[:, None] * v).sum(axis=0), v.sum(axis=0) + 1e-9
                det = haa * hcc - hac * hac
                a += np.clip((hcc * ga - hac * gc) / det, -1, 1)
                c += np.clip((haa * gc - hac * ga) / det, -2, 2)
            yield pa.RecordBatch.from_pydict({"slot": batch["slot"], "tilt": pa.array(a), "base": pa.array(c)})

    return work


def _cut(low: dict[int, int], high: dict[int, int]) -> float:
    """The limit (in thousandths) between two bands' histograms with the least sum of error rates; the middle of the best gap."""
    a, b = np.zeros(1002), np.zeros(1002)
    for k, v in low.items():
        a[k] += v
    for k, v in high.items():
        b[k] += v
    wrong = (a.sum() - np.cumsum(a)) / max(1, a.sum()) + np.cumsum(b) / max(1, b.sum())  # cut after bin k
    best = np.flatnonzero(wrong <= wrong.min() + 1e-9)
    return (float(best.mean()) + 1) / 1000


def fit(bags: DataFrame, rounds: int = ROUNDS, slots: int | None = None) -> tuple[Curves, int, list[float]]:
    """bags (id, band, words) -> the curves, how many slots they have, and the log-likelihood per occurrence of every round."""
    share = bags.sparkSession.sparkContext.broadcast
    if slots is None:
        words = bags.select(F.explode("words").alias("w")).agg(F.approx_count_distinct("w")).first()[0]
        slots = min(MOST, max(LEAST, 1 << int(4 * words).bit_length()))
    # anchors weigh as much as all other documents together, so the scale stays theirs
    total, anchors = bags.agg(F.count("*"), F.count("band")).first()
    weight = max(1.0, (total - anchors) / anchors) if anchors else 1.0
    curves, course = Curves(np.zeros(slots, np.float32), np.full(slots, -30, np.float32)), []
    for r in range(rounds + 1):
        # the first round knows the anchors' levels alone
        rows = bags.mapInArrow(_expect(share((curves, curves.none(NODES))), slots, weight, r == 0), ", ".join(["slot bigint", *(f"{c} double" for c in _SUMS)]))
        sums = materialize(rows.groupBy("slot").agg(*[F.sum(c).alias(c) for c in _SUMS]))
        about = {x["slot"]: list(x)[1:] for x in sums.where("slot < 0").collect()}
        if r:
            course.append(about[-2][0] / max(1.0, about[-2][1]))
        if r == rounds or len(course) > 2 and course[-1] - course[-2] < GAIN or not sum(about[-1]):
            release(sums)
            break
        got = sums.where("slot >= 0").mapInArrow(_newton(np.array(about[-1])), "slot bigint, tilt double, base double").toArrow()
        release(sums)
        # a slot that is not met says nothing
        curves = Curves(np.zeros(slots, np.float32), np.full(slots, -30, np.float32))
        curves.tilt[got["slot"].to_numpy()], curves.base[got["slot"].to_numpy()] = got["tilt"].to_numpy(), got["base"].to_numpy()
    return curves, slots, course


def bags_of(docs: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """docs (key, text), labels (key, band) -> (id, band, words)."""
    known = labels.where(F.col("band").isin(*BANDS)).groupBy(key).agg(F.min("band").alias("band"))
    rows = docs.select(key, "text").join(known, key, "left").select(F.col(key).alias("id"), "band", "text")
    return materialize(rows.mapInArrow(_bags, f"id {dict(docs.dtypes)[key]}, band string, words array<int>"))


def placed(bags: DataFrame, curves: Curves, slots: int) -> DataFrame:
    """bags -> (id, anchor, level): level from 0 (plain) to 1 (demanding), the mean of a document's distribution."""
    final = bags.sparkSession.sparkContext.broadcast((curves, curves.none(FINE)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot, doc, n = _flat(batch, slots)
            level = np.clip((posterior(*final.value, FINE, slot, doc, n)[0] @ FINE - FINE[0]) / (FINE[-1] - FINE[0]), 0, 1)
            none = np.bincount(doc, minlength=n) == 0
            yield pa.RecordBatch.from_arrays([batch["id"], batch["band"], pa.array(level, mask=none)], ["id", "anchor", "level"])

    return materialize(bags.mapInArrow(place, f"id {dict(bags.dtypes)['id']}, anchor string, level double"))


def limits(rows: DataFrame) -> tuple[float, float] | None:
    """The lower limits of the bands middle and advanced by anchors placed (anchor, level)."""
    hist: dict[str, dict[int, int]] = {b: {} for b in BANDS}
    counts = rows.where("anchor is not null and level is not null").groupBy("anchor", F.floor(F.col("level") * 1000).cast("int").alias("bin")).count()
    for b, k, c in counts.collect():
        hist[b][k] = c
    if not hist["advanced"] or not (hist["middle"] or hist["basic"]):
        return None
    return _cut(hist["basic"], hist["middle"]) if hist["basic"] and hist["middle"] else 0.0, _cut(hist["middle"] or hist["basic"], hist["advanced"])


def _band(at: tuple[float, float] | None):
    if at is None:
        return F.lit(None).cast("string")
    return F.when(F.col("level") >= at[1], "advanced").when(F.col("level") >= at[0], "middle").when(F.col("level").isNotNull(), "basic")


def levels(docs: DataFrame, labels: DataFrame, key: str = "doc_id", rounds: int = ROUNDS, slots: int | None = None) -> DataFrame:
    """docs (key, text), labels (key, band) -> (key, level, band, anchor): level from 0 (plain) to 1 (demanding)."""
    bags = bags_of(docs, labels, key)
    curves, slots, _ = fit(bags, rounds, slots)
    rows = placed(bags, curves, slots)
    release(bags)
    return rows.select(F.col("id").alias(key), "level", _band(limits(rows)).alias("band"), "anchor")


def validation(docs: DataFrame, labels: DataFrame, key: str = "doc_id", part: int = 5) -> dict[str, float]:
    """What the model says of judged documents when their judgement is held out, each once: of every part-th anchor by hash, in
    turn, the share placed in its band and the share told right as advanced or not; and the course of the likelihood."""
    fold = F.pmod(F.xxhash64(F.lit(11), key), F.lit(part))
    right = rough = n = 0
    for f in range(part):
        bags = bags_of(docs, labels.where(fold != f), key)
        curves, slots, course = fit(bags)
        rows = placed(bags, curves, slots)
        said = rows.select(F.col("id").alias(key), _band(limits(rows)).alias("said"))
        a, b, c = labels.where(fold == f).join(said, key).where("said is not null").agg(
            F.count_if(F.expr("said = band")), F.count_if(F.expr("(said = 'advanced') = (band = 'advanced')")), F.count("*")
        ).first()
        right, rough, n = right + a, rough + b, n + c
        release(bags)
        release(rows)
    out = {"held_out": n, "same_band": right / max(1, n), "advanced_or_not": rough / max(1, n), "rounds": len(course)}
    return out | {f"likelihood_{i + 1}": v for i, v in enumerate(course)}
