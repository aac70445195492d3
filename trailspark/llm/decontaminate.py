"""Benchmark decontamination by pigeonhole edit matching.

Texts and test items are lower-cased and white space becomes single spaces. An
item of m characters may be hit with up to ``floor(rate * m)`` = k edits; it is
split into k + 1 pieces, of which at least one survives k edits unchanged. One
Aho-Corasick automaton finds all exact piece hits in a whole text; hits of an
item on neighbouring diagonals share one window, which Myers' bit-parallel
distance verifies. An item shorter than ``MIN_CHARS`` characters is one piece
without edits, which has to stand in the text between word boundaries.

The test set is stated, not derived: it is cut by item hash into blocks of at
most about ``BLOCK_CHARS`` characters, and every block is matched against all
texts, so what a worker holds is bounded however large the set grows.

Defined results: a null or empty text holds nothing; null items and
items of white space only match nothing;
repeated rows are judged alike; equal items match under each item id; empty
tables give empty results (or leave the texts as they are); input columns may
have any names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows

ERROR_RATE = 0.08
MIN_CHARS = 32
BLOCK_CHARS = 4_000_000


def normalized(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """``k + 1`` adjoining pieces of near-equal length with their places."""
    cuts = [len(item) * i // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def closest(pattern: str, masks: dict[str, int], text: str) -> tuple[int, int]:
    """Least edit distance of ``pattern`` to a substring of ``text``, and where it ends.

    Myers' bit vectors: bit i of ``up``/``down`` says that the distance rises or
    falls by one from pattern row i to i + 1 in the current text column.
    """
    m = len(pattern)
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    best, end = m, 0
    for at, c in enumerate(text, 1):
        eq = masks.get(c, 0)
        diagonal = (((eq & up) + up) ^ up) | eq | down
        rise = down | (full & ~(diagonal | up))
        fall = up & diagonal
        score += bool(rise & top) - bool(fall & top)
        rise, fall = rise << 1 & full, fall << 1 & full
        vertical = eq | down
        up, down = fall | (full & ~(vertical | rise)), rise & vertical
        if score < best:
            best, end = score, at
    return best, end


class Matcher:
    """The automaton over all pieces of a block of items."""

    def __init__(self, items: list[tuple[int | None, str]], rate: float):
        self.rate, self.items = rate, []
        found: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            text = normalized(text)
            if not text:
                continue
            k, masks = math.floor(rate * len(text)) if len(text) >= MIN_CHARS else 0, {}
            for i, c in enumerate(text):
                masks[c] = masks.get(c, 0) | 1 << i
            for at, piece in pieces(text, k):
                found.setdefault(piece, []).append((len(self.items), at))
            self.items.append((item_id, text, k, masks))
        self.automaton = ahocorasick.Automaton()
        for piece, owners in found.items():
            self.automaton.add_word(piece, (len(piece), owners))
        if found:
            self.automaton.make_automaton()

    def matches(self, text: str | None) -> Iterator[tuple[int | None, int, int, int, int]]:
        """``(item_id, distance, k, start, end)`` of the closest place of each item hit."""
        text = normalized(text)
        if not self.items or not text:
            return
        places: dict[int, set[int]] = {}
        for last, (length, owners) in self.automaton.iter(text):
            for i, at in owners:
                places.setdefault(i, set()).add(last + 1 - length - at)
        for i, diagonals in sorted(places.items()):
            item_id, item, k, masks = self.items[i]
            if len(item) < MIN_CHARS:
                at = next((x for x in sorted(diagonals) if _whole(text, x, x + len(item))), None)
                if at is not None:
                    yield item_id, 0, 0, at, at + len(item)
                continue
            best = None
            for low, high in _runs(sorted(diagonals), k):
                start = max(0, low - k)
                distance, end = closest(item, masks, text[start:high + len(item) + k])
                if distance <= k and (best is None or distance < best[0]):
                    best = (distance, start + end)
            if best:
                yield item_id, best[0], k, max(0, best[1] - len(item)), best[1]


def _whole(text: str, start: int, end: int) -> bool:
    """No word goes on over ``start`` or ``end``."""
    return not any(0 < at < len(text) and text[at - 1].isalnum() and text[at].isalnum()
                   for at in (start, end))


def _runs(values: list[int], gap: int) -> Iterator[tuple[int, int]]:
    low = last = values[0]
    for v in values[1:]:
        if v - last > gap:
            yield low, last
            low = v
        last = v
    yield low, last


def _blocks(benchmark: DataFrame, item_id: str, text: str, rate: float) -> Iterator:
    """Per block of items: a function that gives a worker its matcher."""
    items = benchmark.select(benchmark[f"`{item_id}`"].alias("i"), benchmark[f"`{text}`"].alias("t"))
    total = items.agg(F.sum(F.char_length("t")).alias("n")).first()["n"] or 0
    n = max(1, math.ceil(total / BLOCK_CHARS))
    for b in range(n):
        block = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == b)
        sent = benchmark.sparkSession.sparkContext.broadcast(
            {"items": [(r["i"], r["t"]) for r in block.collect()]})

        def matcher(sent=sent) -> Matcher:
            held = sent.value  # a worker keeps it from task to task, and the automaton with it
            if "matcher" not in held:
                held["matcher"] = Matcher(held["items"], rate)
            return held["matcher"]

        yield matcher


def find_leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
               item_id: str = "item_id", item_text: str = "text",
               rate: float = ERROR_RATE) -> DataFrame:
    """One row per text and item it holds: distance, budget and place (in the normalized text)."""
    picked = docs.select(docs[f"`{doc_id}`"].cast("long").alias("doc_id"),
                         docs[f"`{text}`"].alias("text"))
    out = None
    for matcher in _blocks(benchmark, item_id, item_text, rate):

        def run(rows: dict[str, list], matcher=matcher) -> dict[str, list]:
            m = matcher()
            found = [(d, *x) for d, t in zip(rows["doc_id"], rows["text"], strict=True)
                     for x in m.matches(t)]
            names = ("doc_id", "item_id", "distance", "budget", "start", "end")
            return {c: [x[i] for x in found] for i, c in enumerate(names)}

        part = map_rows(
            picked, run,
            "doc_id long, item_id long, distance int, budget int, start int, end int")
        out = part if out is None else out.union(part)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text",
                  item_id: str = "item_id", item_text: str = "text",
                  rate: float = ERROR_RATE) -> DataFrame:
    """The rows that hold no test item, columns unchanged, nothing shuffled."""
    column = docs.columns.index(text)
    for matcher in _blocks(benchmark, item_id, item_text, rate):

        def run(batches, matcher=matcher):
            m = matcher()
            for batch in batches:
                clean = [next(m.matches(t.as_py()), None) is None for t in batch.column(column)]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
