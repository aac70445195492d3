"""Corpus pipeline: quality rules, near-dedup, decontamination, mixing, sharding.

``STAGES`` lists the stages; each takes ``(spark, docs, sf_dir)`` and returns a
DataFrame that ``run`` writes as Parquet to the shared folder and rereads as
the next stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trailspark.llm.common import table
from trailspark.llm.decontaminate import decontaminate
from trailspark.llm.mixing import mixed_documents
from trailspark.llm.quality import quality_filter
from trailspark.llm.sharding import shuffled
from trailspark.llm.simhash import drop_near_duplicates
from trailspark.runtime import remove_path, scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_filter(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixed_documents(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard and its slot there."""
    return shuffled(docs)


STAGES = [
    ("quality rules", quality),
    ("near dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: SimHash components and the mixing quotas are iterative; no SQL gives the
#: whole run, so the tests hold it against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written once and reread."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        out = scratch_path(spark, "pipeline-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(out)
        if before:  # the last stage's rows stay, for the caller to read
            remove_path(spark, before)
        docs, before = spark.read.parquet(out), out
    return docs
