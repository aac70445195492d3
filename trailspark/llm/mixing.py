"""Mixing sources to target weights by Sainte-Lague apportionment.

Sources ordered by code point (null last) weigh 5, 2, 1, repeating. They share
150 % of all words; a target stops at twice its source's size and the excess is
shared again by weight. The mix consists of equal-token blocks: the house of
blocks is dealt over the shards, and each shard's seats go to the sources with
the highest quotients target / (2 * seats + 1), which gives integer quotas per
shard and source. A source's documents lie in a seeded order on a line of
tokens cut into blocks; its quota takes whole passes over the line and, for
the rest, a run of blocks from a seeded place, in shard order.

Prefix sums are taken within hash buckets of a source and joined by the
buckets' totals, so no source is sorted or summed in one task. Only the table of
sources, a row each, is ranked as a whole.

Defined results: a null text has size 0 and is taken 0 times; a null source is
a source of its own, the last; repeated rows are separate rows; an empty table
gives an empty result; input columns may have any names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import key_part, numbered, pack, settled, small, unpack, words

WEIGHTS = (5, 2, 1)
#: Words in the mix, as a multiple of all words, and in a target, of its source's.
SHARE, MOST = 1.5, 2
SEED = 17
SHARDS = 8
#: Words in a block at most; a hundredth of the smallest source if that is less.
BLOCK_WORDS = 64
#: Rows of a prefix-sum bucket, about, and buckets whose totals are summed in one window
#: partition (a power of two).
BUCKET_ROWS, GROUP = 512, 4096


def _sized(docs: DataFrame, text: str, source: str, doc_id: str) -> DataFrame:
    return pack(docs, text=text, source=source, doc_id=doc_id).select(
        "row", "doc_id", "source", key_part("source").alias("g"), key_part("doc_id").alias("id"),
        F.size(words(F.col("text"))).cast("long").alias("size"),
        F.xxhash64(F.lit(SEED), "doc_id", F.coalesce("text", F.lit("")), "source").alias("u"))


def targets(sized: DataFrame) -> DataFrame:
    """``(g, source, rank, weight, source_size, target)``: one row per source.

    Water filling: by rising cap per weight, the level that the sources not yet
    capped would share is highest exactly where capping ends.
    """
    everything = Window.partitionBy(F.lit(0))
    sums = sized.groupBy("g", "source").agg(F.sum("size").alias("source_size"))
    ranked = sums.withColumn("rank", F.row_number().over(
        everything.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.pmod("rank", F.lit(len(WEIGHTS))) + 1)
                          .cast("int"))
    cap = MOST * F.col("source_size")
    rising = everything.orderBy("fill", "rank")
    level = ((F.col("budget") - F.coalesce(F.sum("cap").over(
        rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        / F.sum("weight").over(rising.rowsBetween(0, Window.unboundedFollowing)))
    return (
        ranked.withColumn("weight", weight).withColumn("cap", cap)
        .withColumn("fill", F.col("cap") / F.col("weight"))
        .withColumn("budget", SHARE * F.sum("source_size").over(everything))
        .withColumn("level", level)
        .withColumn("target", F.least(
            F.col("cap").cast("double"), F.col("weight") * F.max("level").over(everything)))
        .select("g", "source", "rank", "weight", "source_size", "target")
    )


def quotas(goals: DataFrame, shards: int = SHARDS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per source and shard: ``block`` words, ``blocks`` of the source, ``upto`` seats so far.

    ``upto`` is the Sainte-Lague allotment for the house of all shards up to
    this one; as that method is house-monotone, differences are the shard's
    own quotas. A source's seats differ from its rounded share only by what
    rounding leaves, so only the quotients around it are ranked: a number of
    candidates in proportion to the sources, not to the seats.
    """
    everything = Window.partitionBy(F.lit(0))
    least = F.min(F.when(F.col("source_size") > 0, F.col("source_size"))).over(everything)
    block = F.greatest(F.lit(1), F.least(
        F.lit(block_words), F.coalesce(F.floor(least / 100), F.lit(1)))).cast("long")
    of_shard = Window.partitionBy("shard")
    seats = (
        goals.withColumn("block", block)
        .withColumn("blocks", F.ceil(F.col("source_size") / F.col("block")))
        .withColumn("all", F.sum("target").over(everything))
        .withColumn("n", F.count("*").over(everything))
        .withColumn("house", F.round(F.col("all") / F.col("block")).cast("long"))
        .where("target > 0")
        .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
        .withColumn("house", F.floor(F.col("house") * (F.col("shard") + 1) / shards))
        .withColumn("part", F.col("target") / F.col("all"))
        .withColumn("near", F.floor(F.col("house") * F.col("part") + 0.5))
        .withColumn("reach", F.ceil(2 * F.col("n") * F.col("part")) + 1)
        .withColumn("sure", F.greatest(F.lit(0), F.col("near") - F.col("reach")))
        .withColumn("open", F.col("house") - F.sum("sure").over(of_shard))
    )
    won = (
        seats.withColumn("seat", F.explode(F.sequence(
            F.col("sure") + 1, F.col("near") + F.col("reach"))))
        .withColumn("quotient", F.col("target") / (2 * F.col("seat") - 1))
        .withColumn("place", F.row_number().over(
            of_shard.orderBy(F.desc("quotient"), "rank", "seat")))
        .where((F.col("place") <= F.col("open")) & (F.col("seat") <= MOST * F.col("blocks")))
        .groupBy("g", "shard").agg(F.count("*").alias("won"))
    )
    return seats.join(won, ["g", "shard"], "left").select(
        "g", "shard", "block", "blocks",
        (F.col("sure") + F.coalesce("won", F.lit(0))).alias("upto"))


def _overlap(a: Column, b: Column, lo: Column, hi: Column) -> Column:
    return F.greatest(F.lit(0), F.least(b, hi) - F.greatest(a, lo))


def _spread(sized: DataFrame) -> DataFrame:
    """``sized`` with ``place``, by which rows lie on their source's line: ``u``, for the
    second and later of equal rows a hash of it and their number."""
    same = [c for c in sized.columns]
    counted = settled(sized.groupBy(*same).agg(F.count("*").alias("n")))
    return numbered(counted, "g", "u", "id").withColumn(
        "place", F.when(F.col("copy") == 1, F.col("u"))
        .otherwise(F.xxhash64(F.lit(SEED), "u", "copy")))


def _offsets(laid: DataFrame) -> DataFrame:
    """``(g, bucket, offset)``: words of the source in the buckets before each."""
    totals = settled(
        laid.groupBy("g", "bucket").agg(F.sum("size").alias("n"))
        .withColumn("group", F.floor(F.col("bucket") / GROUP)))
    before = lambda *by: F.coalesce(F.sum("n").over(
        Window.partitionBy(*by[:-1]).orderBy(by[-1])
        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    groups = (totals.groupBy("g", "group").agg(F.sum("n").alias("n"))
              .select("g", "group", before("g", "group").alias("base")))
    return totals.join(groups, ["g", "group"]).select(
        "g", "bucket", (F.col("base") + before("g", "group", "bucket")).alias("offset"))


def _plan(goals: DataFrame) -> DataFrame:
    """Per source: ``block`` words, ``blocks``, the first block, and ``upto``, the seats of the
    shards up to each."""
    seats = quotas(goals).groupBy("g", "block", "blocks").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("shard", "upto"))),
                    lambda x: x["upto"]).alias("upto"))
    none = F.array_repeat(F.lit(0).cast("long"), SHARDS)
    return goals.join(seats, "g", "left").select(
        "g", "source_size", "target",
        F.coalesce("block", F.lit(1)).alias("block"),
        F.greatest(F.coalesce("blocks", F.lit(0)), F.lit(1)).alias("blocks"),
        F.coalesce(F.col("upto").cast("array<bigint>"), none).alias("upto")
    ).withColumn("first", F.pmod(F.xxhash64(F.lit(SEED), "g"), F.col("blocks"))
                 ).withColumn("quota", F.element_at("upto", -1))


def _run(seats: Column, first: Column) -> tuple[Column, Column, Column, Column]:
    """Whole passes, and the ends in words of the run of ``seats`` blocks from block ``first``
    on: ``lo`` to ``hi`` and, round the end of the line, the words up to ``over``."""
    block, blocks = F.col("block"), F.col("blocks")
    rest = F.pmod(seats, blocks)
    return (F.floor(seats / blocks), first * block, (first + rest) * block,
            F.greatest(F.lit(0), first + rest - blocks) * block)


def _taken(sized: DataFrame) -> DataFrame:
    """``sized`` (settled) with ``source_size``, ``target``, ``by_shard``, ``taken`` and whole
    ``copies``; a row for each row."""
    goals = settled(targets(sized))
    plan = settled(_plan(goals))
    laid = _spread(sized)
    rows = sized.count()
    bits = max(0, math.ceil(math.log2(max(1, rows / BUCKET_ROWS))))
    bucket = F.shiftrightunsigned("place", 64 - bits) if bits else F.lit(0).cast("long")
    laid = laid.withColumn("bucket", bucket)
    here = Window.partitionBy("g", "bucket").orderBy("place", "id", "size", "u", "copy")
    laid = (
        laid.withColumn("upto_here", F.sum("size").over(
            here.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .join(small(settled(_offsets(laid))), ["g", "bucket"])
        .join(small(plan), "g")
        .withColumn("b", F.col("offset") + F.col("upto_here"))
        .withColumn("a", F.col("b") - F.col("size"))
    )
    a, b, blocks = F.col("a"), F.col("b"), F.col("blocks")

    def of_shard(upto: Column, k: Column) -> Column:
        before = F.coalesce(F.get("upto", k - 1), F.lit(0).cast("long"))
        passes, lo, hi, over = _run(upto - before, F.pmod(F.col("first") + before, blocks))
        return (passes * F.col("size") + _overlap(a, b, lo, hi)
                + _overlap(a, b, F.lit(0).cast("long"), over))

    passes, lo, hi, over = _run(F.col("quota"), F.col("first"))
    middle = F.floor((a + b) / 2)
    inside = ((middle >= lo) & (middle < hi)) | (middle < over)
    return (
        laid.withColumn("by_shard", F.transform("upto", of_shard))
        .withColumn("taken", F.aggregate("by_shard", F.lit(0).cast("long"), lambda x, y: x + y))
        .withColumn("copies", passes + inside.cast("int"))
    )


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
        source: str = "source") -> DataFrame:
    """Per row: ``doc_id, size, source_size, target, taken`` (words, repeats counted) and
    ``by_shard``, the words that each shard takes."""
    sized = settled(_sized(docs, text, source, doc_id).drop("row"))
    return _taken(sized).select(
        "doc_id", "size", "source_size", "target", F.col("taken").cast("long").alias("taken"),
        F.col("by_shard").cast("array<bigint>").alias("by_shard"))


def mixed_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    source: str = "source") -> DataFrame:
    """The mix as whole documents, columns unchanged: each as often as the passes over its
    source hold its middle word."""
    sized = _sized(docs, text, source, doc_id)
    copies = (_taken(settled(sized.drop("row"))).groupBy("g", "id", "u")
              .agg(F.sum("copies").alias("n")).where("n > 0"))
    rows = (sized.groupBy("g", "id", "u").agg(F.first("row").alias("row"))  # combined map-side
            .join(copies, ["g", "id", "u"]))
    return unpack(numbered(rows.select("row", "g", "id", "u", F.col("n").cast("long").alias("n")),
                           "g", "id", "u"), docs.columns)
