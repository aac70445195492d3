"""Two-pass external shuffle into shards.

Pass one scatters the records uniformly into buckets of a size that fits in
memory, by a seeded hash; pass two puts every bucket into a canonical order,
shuffles it by Fisher-Yates with seeded draws, and writes it out. The shuffled
buckets in turn form one random order of all records, which is dealt round the
shards, so shard counts differ by one at most (the ``rows`` law) and slots
have no gaps.

Exactly equal records are counted first and numbered, so even a third of all
rows being the same record scatters evenly; ``COPIES`` of them at a time are
made by one task. The order depends on the records and the seed only, not on
the partitioning. Records are counted by digests (two 64-bit hashes, by which
they are told apart), so a record itself moves once: its first copy goes to its
bucket from where it lies, equal ones being the same there, and only the texts
that have more copies are brought together and copied.

Defined results: nulls are values like any other; an empty table gives an
empty result; records may have any columns of orderable types; columns named
``shard`` and ``slot`` give way to those of the result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailspark.runtime import scratch_path

from .common import numbered, settled, small

SHARDS = 8
SEED = 29
#: Records and bytes of a bucket, about.
BUCKET_ROWS = 1024
BUCKET_BYTES = 16 << 20
#: Equal records that one task makes of their count.
COPIES = 4096
#: Buckets whose totals are summed in one window partition.
GROUP = 4096


def _fisher_yates(n: Column, *key: Column) -> Column:
    """The indices 0 to n - 1, shuffled from the last place down by seeded draws."""

    def swap(a: Column, i: Column) -> Column:
        j = F.pmod(F.xxhash64(*key, i), i + 1).cast("int")  # 0 to i
        at = lambda k: F.slice(a, k + 1, F.lit(1))
        return F.when(j < i, F.concat(
            F.slice(a, F.lit(1), j), at(i), F.slice(a, j + 2, i - j - 1), at(j),
            F.slice(a, i + 2, F.size(a) - i - 1))).otherwise(a)

    steps = F.when(n > 1, F.sequence(n - 1, F.lit(1), F.lit(-1))).otherwise(
        F.array().cast("array<int>"))
    return F.aggregate(steps, F.sequence(F.lit(0), n - 1), swap)


def _digests(record: Column, seed: int) -> list[Column]:
    return [F.xxhash64(F.lit(seed + k), record).alias(f"d{k}") for k in (1, 2)]


def _offsets(held: DataFrame) -> DataFrame:
    """``(bucket, offset)``: how many rows of ``held`` are in the buckets before each."""
    groups = Window.partitionBy("group")
    totals = settled(
        held.groupBy("bucket").agg(F.count("*").alias("n"))
        .withColumn("group", F.floor(F.col("bucket") / GROUP)))
    return (
        totals.groupBy("group").agg(F.sum("n").alias("all"))
        .withColumn("base", F.sum("all").over(
            Window.partitionBy(F.lit(0)).orderBy("group")) - F.col("all"))
        .join(totals, "group")
        .withColumn("offset", F.col("base") + F.sum("n").over(groups.orderBy("bucket"))
                    - F.col("n"))
        .select("bucket", "offset"))


def shuffled(records: DataFrame, shards: int = SHARDS, seed: int = SEED,
             bucket_rows: int = BUCKET_ROWS, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """The records with ``shard`` and ``slot``, a gapless place in the shard."""
    records = records.drop("shard", "slot")
    cols = [F.col(f"`{c}`") for c in records.columns]
    bytes_ = sum((F.octet_length(c.cast("string")) for c, (_, kind) in zip(
        cols, records.dtypes, strict=True) if kind == "string"), F.lit(0))
    size = records.agg(F.count("*").alias("n"), F.sum(F.coalesce(bytes_, F.lit(0))).alias("b")).first()
    buckets = max(1, math.ceil(size["n"] / bucket_rows), math.ceil((size["b"] or 0) / bucket_bytes))

    def scattered(copies: DataFrame) -> DataFrame:
        return (copies.withColumn("h", F.xxhash64(F.lit(seed), "d1", "d2", "copy"))
                .withColumn("bucket", F.pmod("h", F.lit(buckets))))

    key = ["d1", "d2"]
    record = F.struct(*cols).alias("record")
    all_ = records.select(record, *_digests(record, seed))
    counted = settled(records.select(*_digests(record, seed)).groupBy(*key)
                      .agg(F.count("*").alias("n")))
    offsets = _offsets(scattered(numbered(counted, *key, copies=COPIES)))
    first = all_.select(*key, "record", F.lit(1).cast("long").alias("copy"))
    more = numbered(
        all_.join(small(counted.where("n > 1")), key)
        .groupBy(*key).agg(F.first("record").alias("record"), F.first("n").alias("n")),
        *key, copies=COPIES).where("copy > 1").select(*key, "record", "copy")
    held = scattered(first.unionByName(more))
    drawn = (
        held.groupBy("bucket")
        .agg(F.sort_array(F.collect_set(F.struct("h", "copy", "record"))).alias("held"))
        .withColumn("order", _fisher_yates(F.size("held"), F.lit(seed), F.col("bucket")))
        .select("bucket", F.transform("order", lambda i: F.get("held", i)["record"]).alias("held"))
        .select("bucket", F.posexplode("held").alias("place", "record"))
        .join(small(settled(offsets)), "bucket")
        .withColumn("at", F.col("offset") + F.col("place"))
    )
    return drawn.select(
        *[F.col("record").getField(c).alias(c) for c in records.columns],
        F.pmod("at", F.lit(shards)).cast("int").alias("shard"),
        F.floor(F.col("at") / shards).cast("long").alias("slot"))


def write_shards(records: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED) -> None:
    """Write the shuffled records to one folder per shard, each file in slot order."""
    (shuffled(records, shards, seed).sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))


def shard_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``doc_id, size, text_crc32, law, shard, slot, grown_shard, path``.

    The whole documents are shuffled and written as shards to the shared scratch
    folder; size and checksum are those of the texts read back from there. The
    shards stay: ``path`` is the file that holds the row.
    """
    spark = docs.sparkSession
    docs = docs.drop("shard", "slot")
    path = scratch_path(spark, "shards")
    write_shards(docs, path)
    kind = docs.limit(0).withColumns({"slot": F.lit(0).cast("long"), "shard": F.lit(0)}).schema
    back = spark.read.schema(kind).parquet(path)
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return back.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"), F.lit("rows").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
        F.col("_metadata.file_path").alias("path"))
