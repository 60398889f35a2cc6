"""Labels of commit subjects by a model that the caller brings, in numbered batches; and what they would cost."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.functions.metrics import batch_labels
from palimpsest.operators.dims import relabel

#: The labels a model may give, and what is said of each in the prompt.
LABELS = {
    "feat": "something new: a feature, a capability, a section", "fix": "a mistake or a behaviour put right", "docs": "wording, comments or documentation alone",
    "style": "layout, blanks or lint alone", "refactor": "the same behaviour in another form", "perf": "something made faster", "test": "tests",
    "build": "dependencies, packaging, the build", "ci": "the settings of continuous integration", "chore": "upkeep: renames, clean-ups, versions",
    "revert": "an earlier change taken back", "merge": "a merge", "initial": "the first version of the file", "other": "none of these",
}
CONFIDENCE, SOURCE = 0.85, "llm"

#: client(prompt) -> the model's answer.
Client = Callable[[str], str]


def prompt(subjects: list[str]) -> str:
    """What a model is asked for a batch: one line per subject, "number: label"."""
    kinds = "\n".join(f"{k}: {v}" for k, v in LABELS.items())
    asked = "\n".join(f"{i}: {s}" for i, s in enumerate(subjects, 1))
    return f"Give every commit subject one of these labels.\n\n{kinds}\n\nAnswer one line per subject, in order, as number: label, and nothing else.\n\n{asked}"


def ask(client: Client, subjects: list[str], tries: int = 4, pause: float = 1.0) -> list[str]:
    """Labels of a batch; a call that fails is made again after twice as long, and the last failure is raised."""
    for attempt in range(tries):
        try:
            return batch_labels(client(prompt(subjects)), len(subjects), frozenset(LABELS))
        except Exception:
            if attempt == tries - 1:
                raise
            time.sleep(pause * 2**attempt)
    return ["other"] * len(subjects)


def labels(df: DataFrame, key: str, subject: str, make: Callable[[], Client], size: int = 50, tries: int = 4, pause: float = 1.0) -> DataFrame:
    """(key, label): the model's labels; a batch that fails for good has none and is left for the next run. make builds the client
    in the worker, which calls it once per size subjects."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make()
        for batch in batches:
            for i in range(0, len(batch), size):
                part = batch.iloc[i : i + size]
                try:
                    said = ask(client, [s or "" for s in part["subject"]], tries, pause)
                except Exception:
                    continue
                yield pd.DataFrame({key: part[key], "label": said})

    rows = df.where(F.col(key).isNotNull()).select(key, F.col(subject).alias("subject"))
    return rows.mapInPandas(work, f"`{key}` {dict(df.dtypes)[key]}, label string")


def apply_labels(df: DataFrame, given: DataFrame, key: str) -> DataFrame:
    """Records of unknown intent take the labels given (key, label), with their confidence and source."""
    new = {"intent_class": F.col("label"), "intent_confidence": F.lit(CONFIDENCE).cast("float"), "intent_source": F.lit(SOURCE)}
    return relabel(df, given, key, F.col("intent_class") == "unknown", new)


def cost(n: Column, size: int = 50, head: int = 250, each_in: int = 30, each_out: int = 8, per_million: tuple[float, float] = (1.0, 5.0)) -> Column:
    """struct(calls, tokens_in, tokens_out, dollars) of labelling n subjects in batches; every call counts as a full one. What a call and
    a subject are reckoned at are fixed values."""
    calls = F.ceil(n / size)
    tokens_in, tokens_out = calls * (head + size * each_in), calls * (size * each_out)
    dollars = tokens_in / 1e6 * per_million[0] + tokens_out / 1e6 * per_million[1]
    return F.struct(calls.alias("calls"), tokens_in.alias("tokens_in"), tokens_out.alias("tokens_out"), F.round(dollars, 4).alias("dollars"))
