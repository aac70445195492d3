"""Line dedup over content-defined chunks of lines.

A text's lines are hashed; a rolling hash over the last ``ROLL`` line hashes
says where a chunk may end, so boundaries follow the content and a passage is
cut alike wherever it stands. A boundary directly after another, or one that
would leave a single line at an end of the text, is skipped, so all chunks have
two lines or more but in texts of one. Chunks with two lines that hold a word
are grouped by hash and by their bytes over
the whole corpus; every occurrence but the first in the document with the
least id is removed.

Groups carry two numbers, summed before the shuffle, so a chunk that a third
of all texts share is one row a task; the groups are a settled table, so that
the join with their occurrences can split such a chunk over tasks.

Defined results: a null text stays null; a null id counts as the largest;
rows that share an id count as one document, of which each row keeps its own
first occurrence; an empty table gives an empty result; input columns may have
any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fenced, pack, settled, small

#: Line hashes in the rolling window, and the share of places that end a chunk (1 in ...).
ROLL = 2
DIVISOR = 3
MIN_LINES = 2
LAST_ID = (1 << 63) - 1


def _rotated(x: Column, by: int) -> Column:
    return F.shiftleft(x, by).bitwiseOR(F.shiftrightunsigned(x, 64 - by)) if by else x


def _chunks(lines: Column, ends: Column) -> Column:
    """Structs ``(at, n, text)`` of the chunks that end after the lines ``ends``."""
    starts = F.concat(F.array(F.lit(0)), F.transform(ends, lambda e: e + 1))
    stops = F.concat(ends, F.array(F.size(lines) - 1))
    spans = F.filter(
        F.zip_with(starts, stops, lambda a, b: F.struct(a.alias("a"), b.alias("b"))),
        lambda s: s["b"] >= s["a"])
    return F.transform(spans, lambda s: F.struct(
        s["a"].alias("at"), (s["b"] - s["a"] + 1).alias("n"),
        F.array_join(F.slice(lines, s["a"] + 1, s["b"] - s["a"] + 1), "\n").alias("text")))


def chunked(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Packed rows with ``id``, ``text_hash``, ``lines`` and their ``chunks``."""
    rolled = lambda h, i: [
        _rotated(F.coalesce(F.get(F.col("hashes"), i - k), F.lit(0)), k) for k in range(ROLL)]

    def mark(h: Column, i: Column) -> Column:
        out = rolled(h, i)[0]
        for x in rolled(h, i)[1:]:
            out = out.bitwiseXOR(x)
        return F.pmod(F.xxhash64(out), F.lit(DIVISOR)) == 0

    rows = (
        pack(docs, doc_id=doc_id, text=text)
        .select("row", F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("id"),
                F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"),
                F.split("text", "\n").alias("lines"))
        .withColumn("hashes", F.transform("lines", lambda x: F.xxhash64(x)))
        .withColumn("marks", F.transform("hashes", mark))
        .withColumn("ends", F.filter(
            F.sequence(F.lit(0), F.size("marks") - 1),
            lambda i: (i >= MIN_LINES - 1) & (i < F.size("marks") - MIN_LINES)
            & F.get(F.col("marks"), i) & ~F.coalesce(F.get(F.col("marks"), i - 1), F.lit(False))))
        .withColumn("chunks", _chunks(F.col("lines"), F.col("ends")))
    )
    return fenced(rows, ["row"], ["id", "text_hash", "lines", "chunks"])


def _removable(c: Column) -> Column:
    """Two lines with a word at least."""
    return (c["n"] >= MIN_LINES) & c["text"].rlike(r"[^ \t-\r][ \t-\r]*\n\s*[^ \t-\r]")


def _key(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2")]


def repeats(rows: DataFrame) -> DataFrame:
    """``(id, text_hash, at, n)`` of every chunk occurrence to remove."""
    each = rows.select("id", "text_hash", F.explode(
        F.filter("chunks", _removable)).alias("c")).select("id", "text_hash", "c.*")
    same = settled(  # grouping on the text itself is the byte comparison
        each.groupBy(*_key(F.col("text")), "text")
        .agg(F.min("id").alias("first"), F.max("id").alias("last"), F.count("*").alias("times"))
        .where("times > 1").select("k1", "k2", "first")
        .groupBy("k1", "k2").agg(F.min("first").alias("first"), F.count("*").alias("texts"))
        .where("texts = 1").drop("texts"))  # two texts under one 128-bit key: both stay
    keyed = F.sort_array(F.transform(F.filter("chunks", _removable), lambda c: F.struct(
        *_key(c["text"]), c["at"].alias("at"), c["n"].alias("n"))))
    owned = F.transform("keyed", lambda c, i: F.struct(  # in key order: the first is a new key
        c["k1"].alias("k1"), c["k2"].alias("k2"), c["at"].alias("at"),
        c["n"].alias("n"), F.coalesce(
            (F.get("keyed", i - 1)["k1"] != c["k1"]) | (F.get("keyed", i - 1)["k2"] != c["k2"]),
            F.lit(True)).alias("own_first")))
    return (
        rows.select("id", "text_hash", keyed.alias("keyed"))
        .select("id", "text_hash", F.explode(owned).alias("c"))
        .select("id", "text_hash", "c.*")
        .join(same, ["k1", "k2"])
        .where((F.col("id") > F.col("first")) | ~F.col("own_first"))
        .select("id", "text_hash", "at", "n"))


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``doc_id``, the ``text`` without repeated chunks, and line counts."""
    rows = chunked(docs, doc_id, text)
    gone = repeats(rows).groupBy("id", "text_hash").agg(
        F.collect_set(F.struct("at", "n")).alias("gone"))
    cuts = F.sort_array(F.coalesce("gone", F.array().cast("array<struct<at:int,n:int>>")))
    kept = F.flatten(F.zip_with(  # the lines between the cuts
        F.concat(F.array(F.lit(0)), F.transform(cuts, lambda g: g["at"] + g["n"])),
        F.concat(F.transform(cuts, lambda g: g["at"]), F.array(F.size("lines"))),
        lambda a, b: F.slice("lines", a + 1, b - a)))
    light = pack(docs, doc_id=doc_id, text=text).select(
        F.col("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"),
        F.split("text", "\n").alias("lines"))
    return (
        light.join(gone, ["id", "text_hash"], "left")
        .withColumn("kept", kept)
        .select(
            "doc_id", F.array_join("kept", "\n").alias("text"),
            F.coalesce(F.size("lines"), F.lit(0)).alias("n_lines"),
            (F.size("lines") - F.size("kept")).alias("n_removed"),
            F.sort_array("gone").alias("removed")))


HAS_WORD = r"[^ \t-\r]"


def _full(lines: str) -> Column:
    """The places of the lines that hold a word."""
    return F.filter(F.sequence(F.lit(0), F.size(lines) - 1),
                    lambda i: F.get(F.col(lines), i).rlike(HAS_WORD))


def _identified(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``doc_id, id, text_hash, lines`` and ``full``, the places of lines with a word."""
    rows = pack(docs, doc_id=doc_id, text=text).select(
        "doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"),
        F.split("text", "\n").alias("lines"))
    own = ["doc_id", "id", "text_hash"]
    rows = fenced(rows, own, ["lines"])
    return fenced(rows.withColumn("full", _full("lines")), [*own, "lines"], ["full"])


def paired(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``id, text_hash``, the ``texts`` of the lines and the ``pairs`` of successive ones.

    A pair has the keys of its first line and of its second with the blank
    lines before it, and ``k``, the first line's number among those with a word.
    """
    before = lambda k: F.coalesce(F.get("full", k - 1), F.lit(-1))
    rows = _identified(docs, doc_id, text)
    rows = fenced(
        rows.withColumn("heads", F.transform("full", lambda i: F.get("lines", i)))
        .withColumn("tails", F.transform("full", lambda i, k: F.when(
            i - before(k) == 1, F.get("lines", i)).otherwise(
            F.array_join(F.slice("lines", before(k) + 2, i - before(k)), "\n")))),
        ["id", "text_hash"], ["heads", "tails"])
    keys = lambda texts: F.transform(texts, lambda t: F.struct(*_key(t)))
    rows = fenced(
        rows.withColumn("texts", F.array_union("heads", "tails"))
        .withColumn("head_keys", keys("heads")).withColumn("tail_keys", keys("tails")),
        ["id", "text_hash"], ["texts", "head_keys", "tail_keys"])
    pairs = F.transform(
        F.slice("head_keys", F.lit(1), F.greatest(F.size("head_keys") - 1, F.lit(0))),
        lambda a, k: F.struct(
            a["k1"].alias("a1"), a["k2"].alias("a2"),
            F.get("tail_keys", k + 1)["k1"].alias("b1"),
            F.get("tail_keys", k + 1)["k2"].alias("b2"), k.alias("k")))
    return fenced(rows.withColumn("pairs", F.sort_array(pairs)),
                  ["id", "text_hash", "texts"], ["pairs"])


PAIR = ["a1", "a2", "b1", "b2"]


def repeated_pairs(rows: DataFrame) -> DataFrame:
    """``(id, text_hash, a, b)``: lines with a word, by number, to remove."""
    shared_keys = small(settled(  # grouping on the text itself is the byte comparison
        rows.select(F.explode("texts").alias("text")).groupBy(*_key(F.col("text")), "text").agg(
            F.lit(1).alias("one")).groupBy("k1", "k2").agg(F.count("*").alias("texts"))
        .where("texts > 1").select("k1", "k2")))
    same = settled(
        rows.select("id", F.explode("pairs").alias("p")).select("id", "p.*")
        .groupBy(*PAIR).agg(F.min("id").alias("first"), F.count("*").alias("times"))
        .where("times > 1").drop("times")
        .join(shared_keys.toDF("a1", "a2"), ["a1", "a2"], "left_anti")
        .join(shared_keys.toDF("b1", "b2"), ["b1", "b2"], "left_anti"))

    def equal(i: Column, j: Column) -> Column:
        x, y = F.get("pairs", i), F.get("pairs", j)
        out = x["a1"] == y["a1"]
        for c in PAIR[1:]:
            out = out & (x[c] == y[c])
        return F.coalesce(out, F.lit(False))

    # in key order: the first of equal pairs stays, also where the second shares a line with it
    owned = F.transform("pairs", lambda p, i: F.struct(
        *[p[c].alias(c) for c in PAIR], p["k"].alias("k"), (~equal(i - 1, i)).alias("own_first"),
        (equal(i - 1, i) & ~equal(i - 2, i) & (F.get("pairs", i - 1)["k"] + 1 == p["k"]))
        .alias("beside")))
    return (
        rows.select("id", "text_hash", F.explode(owned).alias("p"))
        .select("id", "text_hash", "p.*")
        .join(same, PAIR)
        .where((F.col("id") > F.col("first")) | ~F.col("own_first"))
        .select("id", "text_hash", F.when(
            (F.col("id") == F.col("first")) & F.col("beside"), F.col("k") + 1)
            .otherwise(F.col("k")).alias("a"), (F.col("k") + 1).alias("b")))


def dedup_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """As ``dedup_lines``, without any run of lines that an earlier document holds."""
    gone = repeated_pairs(paired(docs, doc_id, text)).groupBy("id", "text_hash").agg(
        F.sort_array(F.collect_set(F.struct("a", "b"))).alias("gone"))
    last = F.size("full") - 1
    starts = F.transform(
        F.filter("gone", lambda g, i: F.coalesce(
            F.get("gone", i - 1)["b"] + 1 < g["a"], F.lit(True))),
        lambda g: F.when(g["a"] == 0, F.lit(0)).otherwise(F.get("full", g["a"])))
    stops = F.transform(
        F.filter("gone", lambda g, i: F.coalesce(
            F.get("gone", i + 1)["a"] > g["b"] + 1, F.lit(True))),
        lambda g: F.when(g["b"] == last, F.size("lines")).otherwise(F.get("full", g["b"]) + 1))
    cuts = F.coalesce("removed", F.array().cast("array<struct<at:int,n:int>>"))
    kept = F.flatten(F.zip_with(  # the lines between the cuts
        F.concat(F.array(F.lit(0)), F.transform(cuts, lambda g: g["at"] + g["n"])),
        F.concat(F.transform(cuts, lambda g: g["at"]), F.array(F.size("lines"))),
        lambda a, b: F.slice("lines", a + 1, b - a)))
    light = pack(docs, doc_id=doc_id, text=text).select(
        "doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), "text")
    joined = fenced(
        light.join(gone, ["id", "text_hash"], "left").withColumn("lines", F.split("text", "\n")),
        ["doc_id", "gone"], ["lines"])
    joined = fenced(joined.withColumn("full", F.when(F.col("gone").isNotNull(), _full("lines"))),
                    ["doc_id", "gone", "lines"], ["full"])
    joined = fenced(
        joined.withColumn("removed", F.zip_with(starts, stops, lambda a, b: F.struct(
            a.alias("at"), (b - a).alias("n")))), ["doc_id", "lines"], ["removed"])
    return fenced(joined.withColumn("kept", kept), ["doc_id", "lines", "removed"], ["kept"]).select(
        "doc_id", F.array_join("kept", "\n").alias("text"),
        F.coalesce(F.size("lines"), F.lit(0)).alias("n_lines"),
        (F.size("lines") - F.size("kept")).alias("n_removed"), "removed")
