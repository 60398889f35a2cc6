"""Streaming forms of operators: windowed counts with late data, and appending deliveries with carried duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.operators.dims import aligned_union


def windowed_counts(events: DataFrame, width: str = "1 hour", late: str | None = None) -> DataFrame:
    """(start, event_type, n, total) per window, of a table or a stream; late: how long a stream waits for late events."""
    if events.isStreaming:  # watermarks want instants
        events = events.withColumn("ts", F.col("ts").cast("timestamp"))
        events = events.withWatermark("ts", late) if late else events
    out = events.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("w.start").alias("start"), "event_type", "n", "total")


def read_stream(spark, directory: str, schema, name: str) -> DataFrame:
    """The files of a directory whose names match, as a stream."""
    return spark.readStream.schema(schema).option("pathGlobFilter", name).option("recursiveFileLookup", "true").parquet(directory)


def run_available(df: DataFrame, out: str, checkpoint: str, mode: str = "append") -> None:
    """Process what is there, once and exactly once, then stop: a resumable batch."""
    q = df.writeStream.outputMode(mode).format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def first_deliveries(stream: DataFrame, key: str, late: str = "1 day", time: str = "ts") -> DataFrame:
    """Rows of a stream whose key was not met within the watermark."""
    return stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def append_new(spark, target: str, key: str, buckets: int = 64):
    """A foreachBatch function: appends rows whose key the target does not hold; running a batch twice adds nothing.

    The target is laid out by buckets of the key's hash, and a batch reads the key column of those buckets alone that its own
    keys fall in. A stream that needs no target from before has its state in the checkpoint instead: first_deliveries.
    """

    def work(batch: DataFrame, epoch: int) -> None:
        bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket")
        fresh = batch.where(F.col(key).isNotNull()).dropDuplicates([key]).select("*", bucket)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
        if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            held = spark.read.parquet(target)
            mine = [r[0] for r in fresh.select("bucket").distinct().collect()]  # at most buckets
            fresh = aligned_union(held.limit(0), fresh.join(held.where(F.col("bucket").isin(mine)).select(key), key, "left_anti"))
        fresh.write.mode("append").partitionBy("bucket").parquet(target)

    return work


def progress_of(query) -> dict[str, float]:
    """Of a running stream's last progress: batch, rows, rows a second, and the seconds that what is known to wait will take."""
    p = query.lastProgress
    if not p:
        return {"batch": -1, "rows": 0, "rate": 0.0, "eta": 0.0}
    rate = float(p["processedRowsPerSecond"] or 0)
    waiting = sum(float((s["metrics"] or {}).get("numBytesOutstanding", 0) or 0) for s in p["sources"])
    size = max(1.0, float(p["numInputRows"]))
    return {"batch": p["batchId"], "rows": p["numInputRows"], "rate": rate, "eta": waiting / size / rate if rate else 0.0}
