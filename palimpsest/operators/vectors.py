"""Nearest neighbours of a set of queries among all vectors, exact or by an index of cells, and clusters by similarity."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.operators.components import connected_components

#: Queries, and vectors, that one task holds at a time.
BLOCK, PART = 2000, 50_000


def _meet(k: int, least: float):
    """The k nearest of the vectors at the right to every query at the left, by a block product."""

    def work(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = {"query": [], "id": [], "similarity": []}
        if len(left) and len(right):
            size = next((len(v) for v in left["v"] if v is not None), 0)
            left, right = (x[x["v"].map(lambda a: a is not None and len(a) == size)] for x in (left, right))
        if len(left) and len(right):
            right = right.sort_values("id", kind="stable")
            ids, asked = right["id"].to_numpy(), left["id"].to_numpy()
            m, x = np.stack(right["v"].to_numpy()).astype(np.float64).T, np.stack(left["v"].to_numpy()).astype(np.float64)
            step = max(1, 4_000_000 // len(ids))  # products held at a time
            for i in range(0, len(x), step):
                s = x[i : i + step] @ m
                # the k-th greatest; whatever equals it stays until ties are settled
                bar = -np.partition(-s, k - 1, axis=1)[:, k - 1 : k] if k < len(ids) else np.full((len(s), 1), -np.inf)
                r, c = np.nonzero(s >= np.maximum(bar, least))
                order = np.lexsort((c, -s[r, c], r))
                r, c = r[order], c[order]
                first = np.searchsorted(r, r)
                top = np.arange(len(r)) - first < k
                r, c = r[top], c[top]
                found["query"].append(asked[i + r])
                found["id"].append(ids[c])
                found["similarity"].append(s[r, c])
        return pd.DataFrame({c: np.concatenate(v) if v else [] for c, v in found.items()})

    return work


def neighbours(vectors: DataFrame, queries: DataFrame, key: str, vector: str, k: int, least: float = -1.0) -> DataFrame:
    """(query, key, similarity, rank): the k nearest of all vectors to every query, by inner product, ties to the smaller key.

    Queries are cut into blocks and meet every part of the vectors in a block product; each meeting gives at most k rows a query,
    and a window over these few makes the ranking. Vectors of another length than the query's and null vectors meet nothing.
    """
    n = queries.count()
    blocks, salt = max(1, -(-n // BLOCK)), max(8, -(-vectors.select(key).count() // PART))
    q = queries.select(F.lit(0).alias("side"), F.col(key).alias("id"), F.col(vector).alias("v"), F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.lit(salt - 1))).alias("part"))
    v = vectors.select(F.lit(1).alias("side"), F.col(key).alias("id"), F.col(vector).alias("v"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.pmod(F.xxhash64(F.lit(3), key), F.lit(salt)).cast("int").alias("part"))
    kind = dict(vectors.dtypes)[key]

    met = q.groupBy("block", "part").cogroup(v.groupBy("block", "part")).applyInPandas(_meet(k, least), f"query {kind}, id {kind}, similarity double")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("similarity"), "id"))
    return met.withColumn("rank", rank).where(f"rank <= {k}").select("query", F.col("id").alias(key), "similarity", "rank")


#: Vectors that the centres of an index are fitted on, at most, chosen by hash; and centres at most.
FITTED, CELLS = 50_000, 4096


def centres(vectors: DataFrame, key: str, vector: str, cells: int | None = None, fitted: int = FITTED, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """Centres (cells x size) of a spherical k-means, fitted in numpy on a bounded sample: at most fitted vectors, those of least
    hash. By default as many cells as the square root of the number of vectors, up to CELLS."""
    rows = vectors.where(F.col(vector).isNotNull())
    n = rows.count()
    cells = cells or max(1, min(CELLS, round(n**0.5)))
    u = F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1 << 30)) / float(1 << 30)
    some = rows.where(u < min(1.0, 1.2 * fitted / max(1, n))).select(vector).limit(2 * fitted).toPandas()[vector]
    x = np.stack([v for v in some if len(v) == len(some.iloc[0])]).astype(np.float32) if len(some) else np.zeros((1, 1), np.float32)
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(cells, len(x)), replace=False)]
    for _ in range(rounds):
        at = np.argmax(x @ c.T, axis=1)
        total = np.zeros_like(c)
        np.add.at(total, at, x)
        size = np.linalg.norm(total, axis=1, keepdims=True)
        c = np.where(size > 0, total / np.maximum(size, 1e-12), c)
    return c


def indexed_neighbours(vectors: DataFrame, queries: DataFrame, key: str, vector: str, k: int, centre: np.ndarray, probes: int, spill: int = 3, least: float = -1.0) -> DataFrame:
    """As neighbours(), but every vector lies in the cells of its spill nearest centres and a query meets the vectors of its probes
    nearest cells only: k nearest of those. Every vector is indexed; what is missed are neighbours none of whose cells is probed,
    fewer the more probes. A cell of many vectors is cut into parts, so that a hot cell is many tasks."""
    kind, share = dict(vectors.dtypes)[key], vectors.sparkSession.sparkContext.broadcast(centre)

    def cell_of(n: int):
        def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                b = b[b["v"].map(lambda a: a is not None and len(a) == share.value.shape[1])]
                if len(b):
                    s = np.stack(b["v"].to_numpy()).astype(np.float32) @ share.value.T
                    near = np.argsort(-s, axis=1, kind="stable")[:, :n]
                    yield pd.DataFrame({"id": np.repeat(b["id"].to_numpy(), near.shape[1]), "v": list(np.repeat(b["v"].to_numpy(), near.shape[1])), "cell": near.ravel()})

        return work

    placed = lambda df, n: df.select(F.col(key).alias("id"), F.col(vector).alias("v")).mapInPandas(cell_of(n), f"id {kind}, v {dict(vectors.dtypes)[vector]}, cell bigint")
    v, q = placed(vectors, min(spill, len(centre))), placed(queries, min(probes, len(centre)))
    sizes = v.groupBy("cell").agg(F.ceil(F.count("*") / PART).alias("parts"))  # one row per cell
    v = v.join(F.broadcast(sizes), "cell").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))
    q = q.join(F.broadcast(sizes), "cell").withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
    met = q.drop("parts").groupBy("cell", "part").cogroup(v.drop("parts").groupBy("cell", "part")).applyInPandas(_meet(k, least), f"query {kind}, id {kind}, similarity double")
    met = met.groupBy("query", "id").agg(F.max("similarity").alias("similarity"))  # met in several cells
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("similarity"), "id"))
    return met.withColumn("rank", rank).where(f"rank <= {k}").select("query", F.col("id").alias(key), "similarity", "rank")


def similar_clusters(pairs: DataFrame, everything: DataFrame, key: str) -> DataFrame:
    """(key, cluster): components over the pairs (query, key); a vector without a pair is alone."""
    comp = connected_components(pairs.where(f"query <> `{key}`"), "query", key)
    return everything.select(key).join(comp, F.col(key) == F.col("node"), "left").select(key, F.coalesce("component", key).alias("cluster"))


def encode(df: DataFrame, key: str, text: str, encoder, length: int = 2000) -> DataFrame:
    """(key, embedding) by an injected function from a list of texts to vectors, which are brought to unit length; texts are cut as
    encoders do."""

    def unit(v) -> list[float]:
        v = np.asarray(v, np.float32)
        return (v / max(float(np.linalg.norm(v)), 1e-12)).tolist()

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({key: b[key], "embedding": [unit(v) for v in encoder(list(b["t"]))]})

    return df.select(key, F.left(F.coalesce(text, F.lit("")), F.lit(length)).alias("t")).mapInPandas(work, f"`{key}` {dict(df.dtypes)[key]}, embedding array<float>")
