"""Evaluation of models on held-out edits: predict, score, summarise; models and metrics are registries that callers extend."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.functions.metrics import METRICS, mean

#: model(before, intent) -> text.
Model = Callable[[str, str], str]
PROVIDERS: dict[str, Callable[[str], Model]] = {}


def identity(before: str, intent: str) -> str:
    return before


def intent_only(before: str, intent: str) -> str:
    return intent


BASELINES: dict[str, Model] = {"identity": identity, "intent_only": intent_only}


def resolve(name: str) -> Model:
    """A baseline by its name, or provider:model by a registered provider."""
    if name in BASELINES:
        return BASELINES[name]
    provider, _, model = name.partition(":")
    if provider not in PROVIDERS:
        raise ValueError(f"no such model: {name}")
    return PROVIDERS[provider](model)


def predict(edits: DataFrame, model: Model, name: str) -> DataFrame:
    """edits (pair_id, intent_class, intent_text, before_content, after_content) -> with model, predicted and error; a model that
    fails on a record leaves its message and an empty text."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, errors = [], []
            for before, said in zip(batch["before_content"], batch["intent_text"], strict=True):
                try:
                    texts.append(model(before or "", said or ""))
                    errors.append(None)
                except Exception as e:  # one record's failure is its own
                    texts.append("")
                    errors.append(str(e)[:500])
            yield batch.assign(model=name, predicted=texts, error=errors)

    cols = edits.select("pair_id", "intent_class", "intent_text", "before_content", "after_content")
    return cols.mapInPandas(work, "pair_id string, intent_class string, intent_text string, before_content string, after_content string, model string, predicted string, error string")


def scored(predictions: DataFrame, metrics: dict | None = None) -> DataFrame:
    """(model, pair_id, intent_class, error, one column a metric); failed records have null scores."""
    p, g = F.col("predicted"), F.col("after_content")
    cols = [F.when(F.col("error").isNull(), m(p, g)).alias(k) for k, m in (metrics or METRICS).items()]
    return predictions.select("model", "pair_id", "intent_class", "error", *cols)


def summary(scores: DataFrame) -> DataFrame:
    """Means per model, over all records and per class, in one pass; n counts records, n_ok those without an error."""
    names = [c for c in scores.columns if c not in ("model", "pair_id", "intent_class", "error")]
    sets = [["model", "intent_class"], ["model"]]
    out = scores.groupingSets(sets, "model", "intent_class").agg(
        F.grouping("intent_class").alias("all"), F.count("*").alias("n"), F.count_if(F.col("error").isNull()).alias("n_ok"), *[mean(F.col(c)).alias(c) for c in names]
    )
    return out.select("model", F.when(F.col("all") == 1, "all").otherwise(F.coalesce("intent_class", F.lit("unknown"))).alias("intent_class"), "n", "n_ok", *names)


def with_examples(results: DataFrame, examples: DataFrame, columns: list[str]) -> DataFrame:
    """Results (pair_id, ...) with columns of the examples they belong to, by pair_id: order does not count, an example that is
    missing gives nulls, one that is delivered twice counts once."""
    one = examples.where("pair_id is not null").select("pair_id", *columns).dropDuplicates(["pair_id"])
    return results.join(one, "pair_id", "left")
