"""Readers of the file formats that revision corpora come in."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def ordered_jsonl(spark: SparkSession, path: str, schema: StructType | str, required: str) -> DataFrame:
    """Lines of the JSON files below a path, with file_name and line_no, which make the order explicit. Blank lines and lines that
    are not JSON, or lack the required field, are passed over. A file is read whole, so it must fit a task."""
    files = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True).select("value", F.col("_metadata.file_name").alias("file_name"))
    lines = files.select("file_name", F.posexplode(F.split("value", "\n")).alias("i", "line")).where("trim(line) <> ''")
    row = F.from_json("line", schema if isinstance(schema, str) else schema.simpleString(), {"mode": "PERMISSIVE"})
    out = lines.select("file_name", (F.col("i") + 1).alias("line_no"), row.alias("r")).where(F.col("r").isNotNull() & F.col("r").getField(required).isNotNull())
    return out.select("file_name", "line_no", "r.*")


def json_documents(spark: SparkSession, path: str, schema: StructType | str, ok: Column | None = None) -> DataFrame:
    """One document per file; malformed files, and those a condition does not hold for, are passed over."""
    df = spark.read.schema(schema).option("multiLine", "true").option("mode", "DROPMALFORMED").json(path)
    return df if ok is None else df.where(ok)


def names(spark: SparkSession, path: str, column: str = "name") -> DataFrame:
    """A list of names, one a line; blanks around and blank lines dropped."""
    return spark.read.text(path).select(F.trim("value").alias(column)).where(F.col(column) != "")


def journal(spark: SparkSession, path: str, schema: StructType | str, key: str, order: str) -> DataFrame:
    """The latest entry per key of an append-only journal of JSON lines."""
    df = spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    rest = [c for c in df.columns if c != key]
    one = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("r"))
    return one.select(key, *[F.col("r").getField(c).alias(c) for c in rest])


def markdown_files(spark: SparkSession, path: str, pattern: str = "SKILL.md") -> DataFrame:
    """(path, content) of the files below a directory whose names match."""
    df = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).text(path, wholetext=True)
    return df.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("content"))


def log_progress(spark: SparkSession, path: str, pattern: str = r"(\d[\d,]*)/(\d[\d,]*)", eta: str = r"eta=(\d+)s", done: str = r"Done|done|exit: 0") -> DataFrame:
    """(file_name, done, total, eta, finished) per log: what its last line that tells progress says, the seconds to go if that
    line names them, and whether any line says that the work ended."""
    logs = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file_name"), F.split("value", "\n").alias("lines"))
    number = lambda i: F.replace(F.regexp_extract("last", pattern, i), F.lit(","), F.lit("")).cast("bigint")
    rows = logs.select("file_name", F.try_element_at(F.filter("lines", lambda x: x.rlike(pattern)), F.lit(-1)).alias("last"), F.exists("lines", lambda x: x.rlike(done)).alias("finished"))
    return rows.where("last is not null").select("file_name", number(1).alias("done"), number(2).alias("total"), F.regexp_extract("last", eta, 1).try_cast("bigint").alias("eta"), "finished")


def row_counts(spark: SparkSession, path: str) -> DataFrame:
    """(path, rows, bytes) of Parquet files: no column is read, rows come from the files' footers."""
    rows = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes")).agg(F.count("*").alias("rows"))
    return rows.select("path", "rows", "bytes")


def staged_shards(spark: SparkSession, urls: list[str], fetch: Callable[[str], bytes], folder: str) -> DataFrame:
    """A Parquet table whose shards lie behind addresses: each is fetched once, by a task, into a folder all executors share, and
    the table is read from there with its filters and columns pushed down. fetch gets an address and gives bytes."""
    import hashlib

    from palimpsest.sources.sinks import file_system

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            names = []
            for url in batch["url"]:
                fs, base = file_system(folder)
                name = f"{base}/{hashlib.sha1(url.encode()).hexdigest()}.parquet"
                if fs.get_file_info([name])[0].type.name == "NotFound":
                    with fs.open_output_stream(f"{name}.part") as out:
                        out.write(fetch(url))
                    fs.move(f"{name}.part", name)  # a file by that name is whole
                names.append(name)
            yield pd.DataFrame({"name": names})

    spark.createDataFrame([(u,) for u in urls], "url string").repartition(max(1, len(urls))).mapInPandas(work, "name string").count()
    names = [f"{folder}/{hashlib.sha1(u.encode()).hexdigest()}.parquet" for u in urls]
    return spark.read.parquet(*names)


def results(spark: SparkSession, base: str) -> DataFrame:
    """(model, stamp, path, written and the summary's fields) of evaluations written by sinks.write_result: the row over all
    records; written is when its file was last changed."""
    df = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").json(f"{base}/*/summary")
    named = df.withColumns({"path": F.col("_metadata.file_path"), "written": F.col("_metadata.file_modification_time")})
    return named.where("intent_class = 'all'").drop("intent_class")


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """(path, bytes) from file metadata alone."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", F.col("length").alias("bytes"))
