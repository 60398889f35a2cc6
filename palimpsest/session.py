"""Session settings and materialisation of intermediate tables in the folder all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(name: str = "palimpsest", cpus: int = 8, shuffle_partitions: int | None = None) -> SparkSession:
    """A single-machine session for tests and benchmarks; a cluster brings its own settings."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the tables of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """df over at least as many partitions as there are cores: for costly work per row on input that came in few files."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where that is unset a session on one machine gets a folder of its own, which then is
    set; on a cluster, whose executors would not see that folder, it is an error."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="palimpsest-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


_held: set[str] = set()


def materialize(df: DataFrame) -> DataFrame:
    """Write df once as a table in the shared folder and read it back: lineage ends there, and a lost executor costs nothing.

    The folder is removed by release(), by release_all(), or when the driver's JVM ends. Operators release what their result does not
    read; what it reads lazily is for its caller to release.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/palimpsest-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    out = spark.read.schema(df.schema).parquet(path)
    out._palimpsest_path = path
    _held.add(path)
    return out


def release(df: DataFrame) -> None:
    """Remove a materialised table that nothing will read any more."""
    path = getattr(df, "_palimpsest_path", None)
    if path:
        _remove(df.sparkSession, path)


def release_all(spark: SparkSession) -> None:
    """Remove all tables that are materialised still: for the caller of an operator, once its result is written."""
    for path in list(_held):
        _remove(spark, path)


def _remove(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    _held.discard(path)
