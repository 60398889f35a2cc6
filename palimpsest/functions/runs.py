"""Runs of consecutive words as 64-bit hashes, and exact similarity of texts by them."""

from __future__ import annotations

import re

import numpy as np
import xxhash

RUN = 5
_FRONT = re.compile(r"\A﻿?---[ \t]*\r?\n(?:.*?\r?\n)??---[ \t]*(?:\r?\n|\Z)", re.S)
_MUL = np.uint64(0x9E3779B97F4A7C15)


class _Words(dict):
    """word -> 64-bit hash; emptied when it grows beyond what a worker should hold."""

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_words = _Words()


def body_words(text: str | None) -> list[str]:
    """Lower-cased words after a leading frontmatter block; an unclosed block counts as text."""
    return _FRONT.sub("", text or "", count=1).lower().split()


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def run_hashes(words: list[str], short: bool = False) -> np.ndarray:
    """A hash per run of RUN words, in text order; of fewer words none, or with short one per word."""
    n = len(words) - RUN + 1
    if n <= 0 and not (short and words):
        return np.empty(0, np.uint64)
    w = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    if n <= 0:
        return mix(w)
    h = w[:n].copy()
    for i in range(1, RUN):
        h *= _MUL
        h += w[i : i + n]
    return mix(h)


def distinct_runs(text: str | None, short: bool = False) -> np.ndarray:
    """Sorted distinct run hashes of a text; null and empty texts have none, texts of fewer than RUN words none or, with short,
    their words."""
    return np.unique(run_hashes(body_words(text), short))


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Shared over all distinct runs of two sorted arrays; 0 if both are empty."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / max(1, len(a) + len(b) - both)
