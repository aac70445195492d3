"""SimHash near-duplicates through tables of distances to reference fingerprints.

A text's fingerprint takes the majority of each bit over the XXH64 hashes of
its 3-word shingles. Equal fingerprints are one class. For every class the
Hamming distances to ``PIVOTS`` reference fingerprints are computed once and
packed into the row. Candidate classes meet on a key that leaves two of eight
8-bit blocks free, since fingerprints at most two bits apart agree outside two
blocks; a pair goes on only if no coordinate of the distance tables differs by
more than the allowed distance (triangle inequality), and survivors are
verified by their own Hamming distance. The links are closed by connected
components.

At most 2**16 classes can share a key, whatever the corpus, and pairs are made
between classes only, never between copies.

Defined results: a null or empty text has fingerprint zero and is linked like
any other; a null id counts as the largest, and a component of null ids only
has a null ``component_id``; repeated rows share their class; an empty table
gives an empty result; input columns may have any names.
"""

from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import key_part, map_rows, pack, settled, unpack
from .components import components

SHINGLE = 3
MAX_BITS = 2
SEED = 42
#: Reference fingerprints; nine 7-bit distances fit one long.
PIVOTS = 18
PER_LONG = 9
#: 64 bits in this many blocks; two differing bits leave all but two untouched.
BLOCKS = 8


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of a whole text, as a signed integer."""
    w = (text or "").encode().lower().split()  # ASCII only, as bytes
    if not w:
        return 0
    joined, n = b" ".join(w), max(1, len(w) - shingle + 1)
    ends = np.cumsum([len(x) + 1 for x in w])
    starts = (ends - [len(x) + 1 for x in w])[:n].tolist()
    stops = (ends[min(shingle, len(w)) - 1:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    sums = np.zeros(64, np.int64)
    for at in range(0, n, 8192):  # bounded however long the text
        part = slice(at, at + 8192)
        h = np.array([digest(joined[a:b], SEED)
                      for a, b in zip(starts[part], stops[part], strict=True)], "<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        sums += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * sums > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, fp, text_hash)`` per row."""

    def run(rows: dict[str, list]) -> dict[str, list]:
        return {"doc_id": rows["doc_id"],
                "fp": [fingerprint(t, shingle) for t in rows["text"]],
                "text_hash": [_signed(xxhash.xxh64_intdigest((t or "").encode(), SEED))
                              for t in rows["text"]]}

    picked = docs.select(docs[f"`{doc_id}`"].cast("long").alias("doc_id"),
                         docs[f"`{text}`"].alias("text"))
    return map_rows(picked, run, "doc_id long, fp long, text_hash long")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _references(n: int, seed: int) -> list[int]:
    rng = random.Random(seed)
    return [_signed(rng.getrandbits(64)) for _ in range(n)]


def _distance(a: Column, b: Column | int) -> Column:
    return F.bit_count(a.bitwiseXOR(b if isinstance(b, Column) else F.lit(b)))


def _tables(refs: list[int]) -> list[Column]:
    """The distances to the references, ``PER_LONG`` to a long."""
    out = []
    for at in range(0, len(refs), PER_LONG):
        packed = F.lit(0).cast("long")
        for i, ref in enumerate(refs[at:at + PER_LONG]):
            d = _distance(F.col("fp"), ref).cast("long")
            packed = packed.bitwiseOR(F.shiftleft(d, 7 * i))
        out.append(packed.alias(f"t{at // PER_LONG}"))
    return out


def _within(refs: int, most: int) -> Column:
    """No coordinate of the two distance tables differs by more than ``most``."""
    ok = F.lit(True)
    for k in range(refs):
        name, shift = f"t{k // PER_LONG}", 7 * (k % PER_LONG)
        at = lambda side, n=name, s=shift: F.shiftright(
            F.col(f"{side}.{n}"), s).bitwiseAND(F.lit(127))
        ok = ok & (F.abs(at("a") - at("b")) <= most)
    return ok


def links(classes: DataFrame, max_bits: int = MAX_BITS, seed: int = SEED) -> DataFrame:
    """``(u, v)``: distinct fingerprints at most ``max_bits`` (up to 2) bits apart."""
    if max_bits > BLOCKS - 1:
        raise ValueError("max_bits must leave a block untouched")
    refs, width = _references(PIVOTS, seed), 64 // BLOCKS
    keys = []
    for k, free in enumerate(combinations(range(BLOCKS), max_bits)):
        mask = sum(((1 << width) - 1) << (width * b) for b in range(BLOCKS) if b not in free)
        keys.append(F.struct(F.lit(k).cast("byte").alias("k"),
                             F.col("fp").bitwiseAND(F.lit(_signed(mask))).alias("part")))
    keyed = (classes.select("fp", *_tables(refs))
             .select("fp", "t0", "t1", F.inline(F.array(*keys))))
    # Never a broadcast: the planner sizes the exploded rows as if there were one a class.
    return (
        keyed.alias("a").join(
            keyed.alias("b").hint("merge"),
            (F.col("a.k") == F.col("b.k")) & (F.col("a.part") == F.col("b.part"))
            & (F.col("a.fp") > F.col("b.fp")) & _within(len(refs), max_bits)
            & (_distance(F.col("a.fp"), F.col("b.fp")) <= max_bits))
        .select(F.col("a.fp").alias("u"), F.col("b.fp").alias("v"))
    )


def classes(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``(fp, root, component_id)``: each fingerprint's component and its least doc_id."""
    reps = settled(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    found = settled(components(links(reps.select("fp"), max_bits)))
    least = settled(
        found.join(reps, found["node"] == reps["fp"]).groupBy("root")
        .agg(F.min("least").alias("component_id")))
    linked = found.join(least, "root").select(F.col("node").alias("fp"), "root", "component_id")
    return settled(
        reps.join(linked, "fp", "left").select(
            "fp", F.coalesce("root", "fp").alias("root"),
            F.when(F.col("root").isNull(), F.col("least"))
            .otherwise(F.col("component_id")).alias("component_id")))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` per input row."""
    prints = settled(fingerprints(docs, doc_id, text, shingle))
    return prints.join(classes(prints, max_bits), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                         shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each component stays: the least id's, ties by the text's hash."""
    prints = settled(fingerprints(docs, doc_id, text, shingle))
    stay = (
        prints.join(classes(prints, max_bits), "fp")
        .groupBy("root").agg(F.min(F.struct(
            F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("first"))
        .select(key_part("first.doc_id").alias("id"), F.col("first.text_hash").alias("text_hash"))
    )
    rows = pack(docs, doc_id=doc_id, text=text).select(
        "row", key_part("doc_id").alias("id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))
    kept = (rows.join(stay, ["id", "text_hash"], "left_semi")
            .groupBy("id", "text_hash").agg(F.first("row").alias("row")))
    return unpack(kept, docs.columns)
