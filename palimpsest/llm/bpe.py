"""Problem 8: encoding of the whole corpus with a public byte-pair tokenizer.

Method: every piece of a text is merged with a segment tree over the ranks of its adjacent pairs. The root holds the lowest rank
with the leftmost position; a merge changes three leaves and their paths, so a piece of n bytes takes O(n log n) however long
it is. Pieces repeat, so each worker keeps the ids of those it has met.

Defined results: null, empty and blank-only texts: null and empty give an empty list, blanks are encoded as they are. Strings of
special tokens are ordinary text. Vocabularies are read from a rank file whose path is a parameter; its bytes go to the
executors once (the vocabulary's size does not depend on the data).
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The pattern of this family of tokenizers, a fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Where that pattern may cut at blanks: a chunk is a blank and what follows up to the next blank, or a run of blanks. A chunk's
#: pieces do not depend on its neighbours. Blanks are those of Unicode, without the four separators that Python counts as well.
_CHUNK = r" ?[\S\x1c-\x1f]+|[^\S\x1c-\x1f]+(?![\S\x1c-\x1f])|[^\S\x1c-\x1f]+"
_NONE = 1 << 62


def read_ranks(raw: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines()) if a}


class _Kept(dict):
    """key -> value made when first asked for; short keys are kept, up to a number."""

    def __init__(self, make, most: int, longest: int):
        super().__init__()
        self.make, self.most, self.longest = make, most, longest

    def __missing__(self, key: str) -> array:
        out = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.most:
                self.clear()
            self[key] = out
        return out


class Encoder:
    """Encodes texts; remembers chunks and pieces."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.find, self.pieces_of = re.compile(_CHUNK).findall, regex.compile(PATTERN).findall
        self.piece = _Kept(self._piece, 200_000, 64).__getitem__
        self.chunk = _Kept(lambda c: array("i", chain.from_iterable(map(self.piece, self.pieces_of(c)))), 400_000, 48).__getitem__

    def _piece(self, piece: str) -> array:
        data = piece.encode("utf-8", "surrogatepass")
        whole = self.ranks.get(data)
        return array("i", [whole] if whole is not None else self.merge(data))

    def merge(self, data: bytes) -> list[int]:
        ranks, n = self.ranks, len(data)
        part: list = [data[i : i + 1] for i in range(n)]
        size = 1 << max(1, (n - 1).bit_length())
        tree = [_NONE] * (2 * size)
        for i in range(n - 1):
            r = ranks.get(part[i] + part[i + 1])
            if r is not None:
                tree[size + i] = r << 32 | i
        for k in range(size - 1, 0, -1):
            a, b = tree[2 * k], tree[2 * k + 1]
            tree[k] = a if a < b else b
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def put(i: int, value: int) -> None:
            k = size + i
            tree[k] = value
            while k > 1:
                k >>= 1
                a, b = tree[2 * k], tree[2 * k + 1]
                low = a if a < b else b
                if tree[k] == low:
                    break
                tree[k] = low

        while tree[1] != _NONE:
            i = tree[1] & 0xFFFFFFFF
            j = after[i]
            part[i], part[j] = part[i] + part[j], None
            nxt = after[i] = after[j]
            put(j, _NONE)
            if nxt < n:
                before[nxt] = i
                r = ranks.get(part[i] + part[nxt])
                put(i, _NONE if r is None else r << 32 | i)
            else:
                put(i, _NONE)
            p = before[i]
            if p >= 0:
                r = ranks.get(part[p] + part[i])
                put(p, _NONE if r is None else r << 32 | p)
        return [ranks[x] for x in part if x is not None]

    def extend(self, out: array, text: str) -> None:
        out.extend(chain.from_iterable(map(self.chunk, self.find(text))))

    def encode(self, text: str | None) -> array:
        out = array("i")
        if text:
            self.extend(out, text)
        return out


_encoders: dict[int, Encoder] = {}


def encoder_of(raw: bytes) -> Encoder:
    """This worker's encoder for a rank file's bytes."""
    key = hash(raw)
    if key not in _encoders:
        _encoders[key] = Encoder(read_ranks(raw))
    return _encoders[key]


def shared_vocabulary(df: DataFrame, path: str):
    with open(path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode(df: DataFrame, key: str, text: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """(key, ids) of every row of df."""
    shared = shared_vocabulary(df, vocabulary)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder_of(shared.value)
        for batch in batches:
            flat, ends = array("i"), array("i", [0])
            for t in batch[text].to_pylist():
                if t:
                    enc.extend(flat, t)
                ends.append(len(flat))
            ids = pa.ListArray.from_arrays(pa.array(np.frombuffer(ends, np.int32)), pa.array(np.frombuffer(flat, np.int32)))
            yield pa.RecordBatch.from_arrays([batch[key], ids], [key, "ids"])

    return df.select(key, text).mapInArrow(work, f"`{key}` {dict(df.dtypes)[key]}, ids array<int>")


def decode(df: DataFrame, key: str, ids: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """(key, text): what the ids of every row stand for; encoding a text and decoding its ids gives it back."""
    shared = shared_vocabulary(df, vocabulary)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = {i: b for b, i in encoder_of(shared.value).ranks.items()}
        for batch in batches:
            texts = [b"".join(piece[i] for i in x or ()).decode("utf-8", "surrogatepass") for x in batch[ids].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch[key], pa.array(texts, pa.string())], [key, "text"])

    return df.select(key, ids).mapInArrow(work, f"`{key}` {dict(df.dtypes)[key]}, text string")
