"""The header line of every input file, and the files that share one.

Files of one input may have different headers: other column orders, other
extra columns. Each distinct header is one scan of the files under it, so no
line is ever read by another file's header, nothing is joined and no
line is shuffled. What reaches the driver is the distinct headers and the
file names, which Spark's file index holds there anyway.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_FIRST = "path string, header string"
# In a session of its own, so that the caller's settings stay: one file to a
# task, which stops after the file's first line.
_ONE_FILE_PER_TASK = {
    "spark.sql.files.maxPartitionBytes": str(1 << 60),
    "spark.sql.files.openCostInBytes": str(1 << 60),
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1",
}


def _first_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(path, header)`` of every file that is not empty."""
    own = spark.newSession()
    for key, value in _ONE_FILE_PER_TASK.items():
        own.conf.set(key, value)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            # By file as well, should a task be given several.
            names = batch.column(0).to_pylist()
            keep = [i for i, name in enumerate(names) if name not in seen and not seen.add(name)]
            if keep:
                yield batch.take(pa.array(keep))
            if len(seen) == 1:
                return

    lines = own.read.text(path).select(F.col("_metadata.file_path").alias("path"),
                                       F.col("value").alias("header"))
    return lines.mapInArrow(first, _FIRST)


def _as_path(uri: str) -> str:
    """A file's address as the readers take it: decoded, with glob characters escaped."""
    raw = unquote(uri) if urlparse(uri).scheme else uri
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", raw)


def by_header(spark: SparkSession, path: str | list[str]) -> list[tuple[str, str | list[str]]]:
    """``(header line, its files)`` for each distinct header, in the headers' order.

    With one header its files are the path as given; without any line the list is empty.
    """
    rows = (_first_lines(spark, path).groupBy("header")
            .agg(F.collect_list("path").alias("files")).collect())
    if len(rows) == 1:
        return [(rows[0]["header"], path)]
    return sorted((r["header"], sorted(map(_as_path, r["files"]))) for r in rows)
