"""Metrics between a proposed and a wanted text, and prompts and answers of models."""

from __future__ import annotations

import difflib
import re
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from palimpsest.functions.lint import lint
from palimpsest.functions.text import strip, text_of

#: metric(proposed, wanted) -> a score.
Metric = Callable[[Column, Column], Column]
_TOKEN = re.compile(r"\w+")


def exact(pred: Column, gold: Column) -> Column:
    return F.when(strip(text_of(pred)) == strip(text_of(gold)), 1.0).otherwise(0.0)


def _guarded(metric: Callable[[str, str], float], pred: pd.Series, gold: pd.Series) -> pd.Series:
    """The metric row by row; where it fails there is NaN, which means leave out, and other rows keep theirs. Equal rows are
    measured once."""
    known: dict[tuple[str, str], float] = {}
    out = []
    for p, g in zip(pred, gold, strict=True):
        pair = p or "", g or ""
        if pair not in known:
            try:
                known[pair] = float(metric(*pair))
            except Exception:
                known[pair] = float("nan")
        out.append(known[pair])
    return pd.Series(out, dtype=float)


@F.pandas_udf(DoubleType())
def edit_ratio(pred: pd.Series, gold: pd.Series) -> pd.Series:
    """Share of matching characters by longest matching blocks, with the usual treatment of frequent characters."""
    return _guarded(lambda p, g: difflib.SequenceMatcher(None, p, g).ratio(), pred, gold)


def lcs_length(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, by bit-parallel rows: one big integer per token of a."""
    where: dict[str, int] = {}
    for i, t in enumerate(b):
        where[t] = where.get(t, 0) | 1 << i
    row, full = 0, (1 << len(b)) - 1
    for t in a:
        x = row | where.get(t, 0)
        row = x & ~(x - (row << 1 | 1)) & full
    return row.bit_count()


def rouge(pred: str | None, gold: str | None) -> float:
    p, g = _TOKEN.findall((pred or "").lower()), _TOKEN.findall((gold or "").lower())
    if not p or not g:
        return 0.0
    n = lcs_length(p, g)
    return 2 * n / (len(p) + len(g))


@F.pandas_udf(DoubleType())
def rouge_l(pred: pd.Series, gold: pd.Series) -> pd.Series:
    """F1 of the longest common subsequence of words; 0 if either has none."""
    return _guarded(rouge, pred, gold)


def lint_delta(pred: Column, gold: Column) -> Column:
    """Findings of the wanted text less those of the proposed one; an empty text has none."""
    count = lambda c: F.when(text_of(c) == "", 0).otherwise(F.size(lint(c)))
    return (count(gold) - count(pred)).cast("double")


def mean(c: Column) -> Column:
    """Mean without nulls and NaN, rounded to four places."""
    return F.round(F.avg(F.when(~F.isnan(c), c)), 4)


def parse_judgement(answer: Column, keys: tuple[str, ...]) -> Column:
    """struct of whole scores from a model's JSON answer, fenced or not; 0 where there is none."""
    from palimpsest.functions.text import outer_fence_removed

    j = F.from_json(outer_fence_removed(answer), ", ".join(f"{k} double" for k in keys))
    return F.struct(*[F.coalesce(j[k], F.lit(0.0)).alias(k) for k in keys])


def batch_labels(answer: str, expected: int, valid: frozenset[str], default: str = "other") -> list[str]:
    """Labels of a numbered list "n: label"; lines of another form, out of range or with unknown labels are passed over."""
    out = [default] * expected
    for line in answer.splitlines():
        m = re.fullmatch(r"\s*(\d+)[:.)]\s*([A-Za-z]+)\s*", line)
        if m and 0 < int(m[1]) <= expected and m[2].lower() in valid:
            out[int(m[1]) - 1] = m[2].lower()
    return out


def cosine(a: np.ndarray, b: np.ndarray) -> float:
    return float(np.dot(a, b) / ((np.linalg.norm(a) * np.linalg.norm(b)) or 1.0))


def semantic_cosine(make: Callable[[], Callable[[list[str]], Sequence]], length: int = 4000) -> Metric:
    """A metric by an encoder (list of texts -> vectors) that make builds in the worker: the cosine of the two texts' vectors, each
    text cut to what encoders read. Encoders take all texts of a batch at once."""

    @F.pandas_udf(DoubleType())
    def score(pred: pd.Series, gold: pd.Series) -> pd.Series:
        encode = make()
        texts = [(t or "")[:length] for t in [*pred, *gold]]
        v = [np.asarray(x, float) for x in encode(texts)]
        return pd.Series([cosine(a, b) for a, b in zip(v[: len(pred)], v[len(pred) :], strict=True)], dtype=float)

    return score


#: What a judge is asked to score, and the most of each. Fixed values, as are the lengths texts are cut to.
JUDGED = {"faithfulness": 2, "preservation": 2, "format": 2, "overall": 5}
JUDGE_LENGTHS = {"intent": 4000, "before": 12_000, "gold": 12_000, "pred": 12_000}


def judge_prompt(intent: str, before: str, gold: str, pred: str) -> str:
    """What a judge is asked about one edit. Texts are put in as they are, braces and all."""
    cut = {k: (v or "")[: JUDGE_LENGTHS[k]] for k, v in (("intent", intent), ("before", before), ("gold", gold), ("pred", pred))}
    keys = ", ".join(f'"{k}": 0-{most}' for k, most in JUDGED.items())
    return (
        "Judge an edit of a skill file. faithfulness: was the intent carried out; preservation: was the rest kept; format: are frontmatter and structure sound; overall: as a whole, the reference being the edit that was made.\n"
        f"Answer with one JSON object, {{{keys}, \"rationale\": text}}, and nothing else.\n\nINTENT:\n{cut['intent']}\n\nBEFORE:\n{cut['before']}\n\nREFERENCE:\n{cut['gold']}\n\nEDIT:\n{cut['pred']}\n"
    )


def judged(make: Callable[[], Callable[[str], str]], pred: Column, gold: Column, intent: Column, before: Column) -> Column:
    """struct(faithfulness, preservation, format, overall) by a model (prompt -> answer) that make builds in the worker; null where
    the call fails, 0 where the answer is no JSON object."""

    @F.pandas_udf("string")
    def answer(p: pd.Series, g: pd.Series, i: pd.Series, b: pd.Series) -> pd.Series:
        client, out = make(), []
        for x in zip(i, b, g, p, strict=True):
            try:
                out.append(client(judge_prompt(*x)))
            except Exception:
                out.append(None)
        return pd.Series(out, dtype=object)

    said = answer(pred, gold, intent, before)
    return F.when(said.isNotNull(), parse_judgement(said, tuple(JUDGED)))


METRICS = {"exact_match": exact, "edit_dist_ratio": edit_ratio, "rouge_l": rouge_l, "linter_delta": lint_delta}
