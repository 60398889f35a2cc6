"""Snapshots of repositories as tar archives: members as rows."""

from __future__ import annotations

import re
import tarfile
import zlib
from collections.abc import Iterator
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from palimpsest.sources.sinks import file_system

SCHEMA = "archive string, status string, root string, head_sha string, path string, size bigint, content string, binary_or_oversize boolean"
_SHA = re.compile(r".+-([0-9a-f]{7,40})$")


def tar_members(spark: SparkSession, path: str, most_bytes: int = 500_000_000, most_content: int = 1_000_000, batch: int = 200) -> DataFrame:
    """One row per regular file of every archive: content as text, or null with the flag set if it is larger than most_content
    or not UTF-8. The first part of members' paths is the root, which may end with the commit. An archive beyond most_bytes, or
    one that cannot be read, gives one row with its status (too_large, broken) and no member; members before the break are kept.

    Only names and sizes go through Spark: a task opens its archives itself and passes over their members once, so that it holds
    a batch of members at a time, never an archive. Archives are shared out one to a task."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    names = ["archive", "status", "root", "head_sha", "path", "size", "content", "binary_or_oversize"]

    def members(name: str) -> Iterator[tuple]:
        fs, inner = file_system(name)
        try:
            with fs.open_input_stream(inner, compression=None) as raw, tarfile.open(fileobj=raw, mode="r|*") as tar:
                for m in tar:
                    root, _, rest = m.name.partition("/")
                    if m.isfile() and rest:
                        text = None
                        if m.size <= most_content:
                            try:
                                text = tar.extractfile(m).read().decode("utf-8")
                            except UnicodeDecodeError:
                                text = None
                        sha = _SHA.match(root)
                        yield name, "ok", root, sha[1] if sha else "", rest, m.size, text, text is None
        except (tarfile.TarError, EOFError, OSError, zlib.error) as e:
            if isinstance(e, FileNotFoundError):
                raise
            yield name, "broken", None, None, None, None, None, None

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for name, size in zip(b["path"], b["length"], strict=True):
                rows = iter([(name, "too_large", None, None, None, size, None, None)]) if size > most_bytes else members(name)
                while some := list(islice(rows, batch)):
                    yield pd.DataFrame(some, columns=names)

    n = max(1, listed.count())
    return listed.repartition(min(n, 10_000)).mapInPandas(work, SCHEMA)
