"""Line dedup over content-defined chunks, refined to lines at their edges.

Lines that hold a word are hashed, and a rolling hash runs over every two
successive line hashes. A text is cut after the place where the rolled hash is
less than on either side, so cuts follow the content, a passage is cut alike
wherever it stands, and every chunk has two lines or more. Chunks are grouped
by their lines over the whole corpus; of a repeated one the first occurrence,
in the text with the least id, stays and the others go.

What a passage has outside its whole chunks, at either end, is found on a finer
level: chunks of two lines at every place that has a line left, those that
reach over the edge of a chunk that went included. The first occurrence with
both lines left owns such a chunk if it is repeated or inside a chunk that stayed
for another's sake, and its lines stay; of the others the lines go that own
nothing. So a line goes only with a neighbour beside which it still stands, whole,
in a text that keeps both.

Line hashes stand for the lines' bytes: texts of lines are grouped by hash and
bytes, and a hash with two of them under it takes its texts out.

A group carries its least occurrence and a count, summed before the shuffle, so
a chunk that a third of all texts share is one row a task; the groups are a
settled table, so that the join with their occurrences can split such a chunk
over tasks.

Defined results: a null text stays null; a null id counts as the largest; rows
equal in id and text are one document and keep the same lines, rows that share
an id only go by their text's hash; blank lines go with the lines around them;
an empty table gives an empty result; input columns may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fenced, settled, small
from .lines import _identified, _key

OWN = ["id", "text_hash"]


def line_keys(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``id, text_hash``, the distinct ``texts`` of the lines, and the keys of the lines with
    a word: ``heads`` of the line alone, ``tails`` with the blank lines before it."""
    before = lambda k: F.coalesce(F.get("full", k - 1), F.lit(-1))
    rows = _identified(docs, doc_id, text)
    rows = fenced(
        rows.withColumn("head", F.transform("full", lambda i: F.get("lines", i)))
        .withColumn("tail", F.transform("full", lambda i, k: F.when(
            i - before(k) == 1, F.get("lines", i)).otherwise(
            F.array_join(F.slice("lines", before(k) + 2, i - before(k)), "\n")))),
        OWN, ["head", "tail"])
    keys = lambda texts: F.transform(texts, lambda t: F.struct(*_key(t)))
    return fenced(
        rows.withColumn("texts", F.array_union("head", "tail"))
        .withColumn("heads", keys("head")).withColumn("tails", keys("tail")),
        OWN, ["texts", "heads", "tails"])


def _pairs() -> Column:
    """The rolled hash ``k1`` of each two successive lines, and a second one to tell them by."""
    return F.transform(
        F.slice("heads", F.lit(1), F.greatest(F.size("heads") - 1, F.lit(0))),
        lambda head, k: F.struct(
            F.xxhash64(head, F.get("tails", k + 1)).alias("k1"),
            F.xxhash64(F.lit(1), head, F.get("tails", k + 1)).alias("k2")))


def chunks(rows: DataFrame) -> DataFrame:
    """``id, text_hash, k1, k2, a, b``: content-defined chunks, from line to line among those
    with a word; texts with two such lines at least."""
    rows = fenced(rows.withColumn("pairs", _pairs()), [*OWN, "heads", "tails"], ["pairs"])

    def least(k: Column) -> Column:
        here, left, right = (F.get("pairs", x)["k1"] for x in (k, k - 1, k + 1))
        return F.coalesce((here < left) & (here < right), F.lit(False))

    ends = F.filter(F.sequence(F.lit(0), F.size("pairs") - 1), least)
    rows = fenced(rows.where(F.size("pairs") > 0).withColumn("ends", ends),
                  [*OWN, "heads", "tails"], ["ends"])
    spans = F.zip_with(
        F.concat(F.array(F.lit(0)), F.transform("ends", lambda e: e + 1)),
        F.concat("ends", F.array(F.size("heads") - 1)),
        lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    lines = (F.get("heads", F.col("s.a")),
             F.slice("tails", F.col("s.a") + 2, F.col("s.b") - F.col("s.a")))
    return (
        rows.select(*OWN, "heads", "tails", F.explode(spans).alias("s"))
        .select(*OWN, F.xxhash64(*lines).alias("k1"), F.xxhash64(F.lit(1), *lines).alias("k2"),
                "s.a", "s.b"))


def fine_chunks(rows: DataFrame, decided: DataFrame) -> DataFrame:
    """``id, text_hash, k1, k2, a, b, whole, needed``: two successive lines each, of which
    one at least is left by ``decided``; ``whole`` if both are, ``needed`` if both own."""
    rows = fenced(rows.withColumn("pairs", _pairs()), OWN, ["pairs"])
    # Maps, so that looking lines up stays linear in them.
    flags = lambda c: F.when(F.size(c) > 0, F.map_from_arrays(
        c, F.transform(c, lambda g: F.lit(True)))).alias(c)
    rows = rows.join(decided.select(*OWN, flags("gone"), flags("owned")), OWN, "left")
    has = lambda c, k: F.coalesce(F.element_at(c, k), F.lit(False))
    found = F.filter(F.transform("pairs", lambda p, k: F.struct(
        p["k1"].alias("k1"), p["k2"].alias("k2"), k.alias("a"), (k + 1).alias("b"),
        (has("gone", k).cast("int") + has("gone", k + 1).cast("int")).alias("went"),
        (has("owned", k) & has("owned", k + 1)).alias("needed"))), lambda x: x["went"] < 2)
    return (rows.select(*OWN, F.explode(found).alias("c")).select(*OWN, "c.*")
            .withColumn("whole", F.col("went") == 0).drop("went"))


def _collided(rows: DataFrame) -> DataFrame | None:
    """Texts with a line whose key another line has; None, as good as ever, if there are none."""
    keyed = rows.select(*OWN, F.explode("texts").alias("text")).select(*OWN, *_key(F.col("text")), "text")
    shared = settled(  # grouping on the text itself is the byte comparison
        keyed.groupBy("k1", "k2", "text").agg(F.lit(1).alias("one"))
        .groupBy("k1", "k2").agg(F.count("*").alias("texts")).where("texts > 1").select("k1", "k2"))
    if shared.isEmpty():
        return None
    return settled(keyed.join(small(shared), ["k1", "k2"]).select(*OWN).distinct())


def _judged(each: DataFrame, owner: Column, counts: Column) -> DataFrame:
    """``id, text_hash, gone, owned``: per text, the numbers of the lines in chunks that
    ``counts`` holds for, those of the occurrence that is ``owner`` (both aggregates) apart."""
    same = settled(
        each.groupBy("k1", "k2").agg(owner.alias("owner"), counts.alias("counts"))
        .where(F.col("counts") & F.col("owner").isNotNull()).drop("counts"))
    owns = F.struct(*OWN, "a") == F.col("owner")
    numbers = lambda own: F.array_distinct(F.flatten(F.transform(
        F.filter("spans", lambda s: s["own"] == own), lambda s: F.sequence(s["a"], s["b"]))))
    return (
        each.join(same, ["k1", "k2"]).select(*OWN, F.struct(owns.alias("own"), "a", "b").alias("s"))
        .groupBy(*OWN).agg(F.collect_set("s").alias("spans"))
        .select(*OWN, numbers(True).alias("owned"),
                F.array_except(numbers(False), numbers(True)).alias("gone")))


def judged_lines(rows: DataFrame) -> DataFrame:
    """``id, text_hash, gone``: the numbers of the lines to remove, where there are any, and
    ``fine``, how many of them the second level found."""
    collided = _collided(rows)
    rows = rows.select(*OWN, "heads", "tails")
    if collided is not None:
        rows = rows.join(small(collided), OWN, "left_anti")
    rows = settled(rows)  # the keys, 32 bytes a line: both levels read them twice
    first, repeated = F.struct(*OWN, "a"), F.count("*") > 1
    coarse = settled(_judged(chunks(rows), F.min(first), repeated))
    fine = _judged(fine_chunks(rows, coarse), F.min(F.when(F.col("whole"), first)),
                   repeated | F.max("needed"))
    none = F.array().cast("array<int>")
    of = lambda side, c: F.coalesce(F.col(f"{side}.{c}"), none)
    more = F.array_except(of("f", "gone"), of("c", "gone"))
    return (
        coarse.alias("c").join(fine.alias("f"), OWN, "full")
        .select(*OWN, F.sort_array(F.concat(of("c", "gone"), more)).alias("gone"),
                F.size(more).alias("fine"))
        .where(F.size("gone") > 0))


def dedup_chunks(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``doc_id``, the ``text`` without the lines that go, ``n_lines``, ``n_removed``,
    the ``removed`` stretches of lines, and ``n_fine``, how many lines the second level found."""
    gone = judged_lines(line_keys(docs, doc_id, text))
    rows = _identified(docs, doc_id, text)
    joined = fenced(
        rows.join(gone, OWN, "left").withColumn("last", F.size("full") - 1),
        ["doc_id", "lines", "full", "gone", "fine"], ["last"])
    # Blank lines at an end of the text, or between lines that go, go with them.
    ends = lambda by: F.filter("gone", lambda g, i: F.coalesce(
        F.get("gone", i + by) != g + by, F.lit(True)))
    starts = F.transform(ends(-1), lambda g: F.when(g == 0, F.lit(0)).otherwise(F.get("full", g)))
    stops = F.transform(ends(1), lambda g: F.when(g == F.col("last"), F.size("lines"))
                        .otherwise(F.get("full", g) + 1))
    joined = fenced(
        joined.withColumn("removed", F.zip_with(starts, stops, lambda a, b: F.struct(
            a.alias("at"), (b - a).alias("n")))), ["doc_id", "lines", "fine"], ["removed"])
    cuts = F.coalesce("removed", F.array().cast("array<struct<at:int,n:int>>"))
    kept = F.flatten(F.zip_with(  # the lines between the cuts
        F.concat(F.array(F.lit(0)), F.transform(cuts, lambda g: g["at"] + g["n"])),
        F.concat(F.transform(cuts, lambda g: g["at"]), F.array(F.size("lines"))),
        lambda a, b: F.slice("lines", a + 1, b - a)))
    return fenced(joined.withColumn("kept", kept), ["doc_id", "lines", "removed", "fine"], ["kept"]).select(
        "doc_id", F.array_join("kept", "\n").alias("text"),
        F.coalesce(F.size("lines"), F.lit(0)).alias("n_lines"),
        (F.size("lines") - F.size("kept")).alias("n_removed"), "removed",
        F.coalesce("fine", F.lit(0)).alias("n_fine"))
