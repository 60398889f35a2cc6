"""Writers: versioned tables, routed subsets, journals."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.functions.text import safe_name


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm


def file_system(path: str):
    """pyarrow's file system of a path, and the path within it: for tasks that read or write files themselves."""
    import pyarrow.fs

    if re.match(r"[a-z][a-z0-9]*:/(?!/)", path):  # file:/x, as Spark writes it
        path = path.replace(":/", ":///", 1)
    fs, inner = pyarrow.fs.FileSystem.from_uri(path) if "://" in path else (pyarrow.fs.LocalFileSystem(), path)
    fs.create_dir(inner, recursive=True) if not re.search(r"\.\w+$", inner) else None
    return fs, inner


def _pointers(spark: SparkSession, table: str) -> list[str]:
    """Names of a table's pointers, the one that counts last."""
    folder, fs, _ = _fs(spark, f"{table}/CURRENT")
    return sorted(x.getPath().getName() for x in fs.listStatus(folder)) if fs.exists(folder) else []


def write_version(df: DataFrame, table: str, rows_per_file: int = 0) -> str:
    """Write df as a new version below table and point to it. A table may so be rewritten from itself: what is read is never
    overwritten. Pointers are empty files named by number and version, of which the greatest counts; one is only ever added, so
    that a reader sees the old version or the new one, and a crash leaves the old one. Stores that rename without atomicity do."""
    spark = df.sparkSession
    version = f"v-{uuid.uuid4().hex}"
    w = df.write.option("compression", "zstd")
    if rows_per_file:
        w = w.option("maxRecordsPerFile", rows_per_file)
    w.parquet(f"{table}/{version}")
    last = _pointers(spark, table)[-1:]
    number = int(last[0].split("-", 1)[0]) + 1 if last else 1
    pointer, fs, _ = _fs(spark, f"{table}/CURRENT/{number:020d}-{version}")
    fs.create(pointer, False).close()
    return version


def read_current(spark: SparkSession, table: str) -> DataFrame:
    last = _pointers(spark, table)
    if not last:
        raise FileNotFoundError(f"no version of {table}")
    return spark.read.parquet(f"{table}/{last[-1].split('-', 1)[1]}")


def write_lines(df: DataFrame, column: str, path: str) -> None:
    """A list of texts, one a line, in order; written as one file, as such lists are the keys of work to be done."""
    df.select(F.col(column).cast("string")).where(F.col(column).isNotNull()).orderBy(column).coalesce(1).write.mode("overwrite").text(path)


def write_documents(df: DataFrame, path: str, by: str | None = None) -> None:
    """JSON lines, characters kept as they are; with by, the rows of every value of it below a folder of that (safe) name."""
    if by is None:
        df.write.mode("overwrite").json(path)
        return
    named = df.withColumn("__by", safe_name(F.col(by)))
    named.repartition("__by").write.mode("overwrite").partitionBy("__by").json(path)


def write_mapping(df: DataFrame, key: str, value: str, path: str) -> None:
    """{"key": ..., "value": ...} lines of a mapping, each key once (its greatest value): a mapping of any size is no one document."""
    df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.max(value).alias("value")).write.mode("overwrite").json(path)


def write_result(scores: DataFrame, summary: DataFrame, model: str, base: str, stamp: str) -> str:
    """The result of one evaluation below base, in a folder named by time and model: the summary and the scores of every record."""
    safe = re.sub(r"[:/]", "_", model)
    path = f"{base}/{stamp}__{safe}"
    keep = [c for c in summary.columns if c != "model"]
    summary.select(F.lit(model).alias("model"), F.lit(stamp).alias("stamp"), *keep).coalesce(1).write.mode("overwrite").json(f"{path}/summary")
    scores.write.mode("overwrite").json(f"{path}/scores")
    return path


def route(df: DataFrame, sinks: Mapping[str, Column | None], base: str) -> None:
    """Write the rows of every condition to a table of its own; the rows are computed once."""
    kept = df.persist()
    for name, when in sinks.items():
        write_version(kept if when is None else kept.where(when), f"{base}/{name}")
    kept.unpersist()


def append_journal(df: DataFrame, path: str) -> None:
    """Append rows to a journal of JSON lines."""
    df.write.mode("append").json(path)


def upload(spark: SparkSession, folder: str, put: Callable[[str, str], None], dry_run: bool = True) -> DataFrame:
    """(path, bytes, status) of all files below a folder, each handed to put(name below the folder, path) by a task; with dry_run
    nothing is handed over and the table says what would be. One that fails has its message for a status."""
    base = folder.rstrip("/") + "/"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", F.col("length").alias("bytes"))
    if dry_run:
        return files.withColumn("status", F.lit("dry run"))

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            said = []
            for path in b["path"]:
                try:
                    put(path.split(base, 1)[-1], path)
                    said.append("ok")
                except Exception as e:
                    said.append(str(e)[:500] or "failed")
            yield b.assign(status=said)

    return files.mapInPandas(work, "path string, bytes bigint, status string")
