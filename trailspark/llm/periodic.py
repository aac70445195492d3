"""Runs of repeating words, found through longest common extensions on a difference cover.

A run is a stretch of consecutive words with smallest period ``q``, at least
``max(MIN_LENGTH, MIN_EXPONENT * q)`` words long, that no neighbouring word
extends keeping the period. For every period ``q`` the grid points ``0, q, 2q,
...`` of a text are compared with their successors (a harmonic sum of pairs,
n log n in all): a run covers at least ``MIN_EXPONENT - 1`` of them, and the
longest common extensions of the first one, forwards and backwards, give its
ends.

Extensions come from ``Extensions``: only the suffixes at positions in a
difference cover modulo ``COVER`` are sorted (prefix doubling in steps of the
modulus, which stay on the cover). For any two positions some shift below the
modulus brings both onto the cover, so a query compares that many words and
then reads the rest from a sparse table of range minima over the neighbours'
common prefixes. The backward structure, on the reversed text, is built only
if a grid point passes forwards.

Each text is one row's work, vectorized; nothing is shuffled.

Defined results: a null text is empty; a text without runs has an empty list
and comes back with its words joined by one space; repeated rows each give
their row; an empty table gives an empty result; other columns are not read
and may have any names; a null id stays null.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_rows, words

MIN_LENGTH = 6
MIN_EXPONENT = 4
#: A difference cover: every residue modulo COVER[0] is a difference of two of COVER[1].
COVER = (13, (0, 1, 3, 9))
#: Grid pairs compared in one vectorized step.
PAIRS = 1 << 18

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def cover_shifts(modulus: int, cover: tuple[int, ...]) -> np.ndarray:
    """``[i, j]``: the least shift that brings residues ``i`` and ``j`` onto the cover."""
    on = np.zeros(modulus, bool)
    on[list(cover)] = True
    at = np.arange(modulus)
    both = np.stack([on[(at[:, None] + d) % modulus] & on[(at[None, :] + d) % modulus]
                     for d in range(modulus)])
    if not both.any(axis=0).all():
        raise ValueError("not a difference cover")
    return both.argmax(axis=0)


SHIFTS = cover_shifts(*COVER)


def _dense(key: np.ndarray) -> tuple[np.ndarray, int]:
    """Ranks from 0 of the rows of sortable columns, and how many differ."""
    order = np.lexsort(key[::-1])
    new = np.zeros(len(order), np.int64)
    for column in key:
        c = column[order]
        new[1:] |= c[1:] != c[:-1]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(new)
    return rank, int(new.sum()) + 1


class Extensions:
    """Longest common extensions to the right of a sequence of ids, none negative."""

    def __init__(self, ids: np.ndarray):
        v, cover = COVER
        n, self.n = len(ids), len(ids)
        self.w = np.concatenate([ids, np.full(2 * v, -1, np.int64)])
        self.nth = np.full(v, -1)  # a residue's place in the cover
        self.nth[list(cover)] = np.arange(len(cover))
        pos = (np.arange(0, n, v)[:, None] + np.array(cover)).ravel()
        pos = pos[pos < n]  # ascending; a suffix v * k further is len(cover) * k places on
        m, self.per = len(pos), len(cover)
        # Names of the first v words: as many words to a key as fit into 63 bits.
        bits = int(ids.max(initial=0) + 1).bit_length()
        fit, keys = max(1, 63 // bits), []
        for k in range(0, v, fit):
            key = np.zeros(m, np.int64)
            for x in range(k, min(v, k + fit)):
                key = (key << bits) | (self.w[pos + x] + 1)
            keys.append(key)
        rank, kinds = _dense(np.stack(keys))
        names = [rank]  # names of the first v, 2v, 4v ... words
        while kinds < m:
            step = self.per << (len(names) - 1)
            later = np.zeros(m, np.int64)
            later[:max(0, m - step)] = rank[step:] + 1
            rank, kinds = _dense(np.stack([rank, later]))
            names.append(rank)
        self.rank, order = rank, np.empty(m, np.int64)
        order[rank] = np.arange(m)
        # Common prefixes of neighbours: from the longest names down, then word by word.
        a, b = order[:-1].copy(), order[1:].copy()
        common = np.zeros(max(m - 1, 0), np.int64)
        for level in range(len(names) - 1, -1, -1):
            inside = np.flatnonzero((a < m) & (b < m))
            same = inside[names[level][a[inside]] == names[level][b[inside]]]
            common[same] += v << level
            a[same] += self.per << level
            b[same] += self.per << level
        common += self._direct(pos[order[:-1]] + common, pos[order[1:]] + common, v)
        self.minima = [common]  # sparse table: minima of 1, 2, 4 ... neighbours
        while 2 << (len(self.minima) - 1) <= len(common):
            last, half = self.minima[-1], 1 << (len(self.minima) - 1)
            self.minima.append(np.minimum(last[:-half], last[half:]))

    def _direct(self, i: np.ndarray, j: np.ndarray, most: np.ndarray | int) -> np.ndarray:
        """Words equal from ``i`` and ``j`` on, ``most`` at most; the end equals nothing."""
        out, live = np.zeros(len(i), np.int64), np.arange(len(i))
        most = np.broadcast_to(most, len(i))
        for k in range(COVER[0]):
            live = live[most[live] > k]
            if not len(live):
                break
            a, b = i[live] + k, j[live] + k
            live = live[(np.maximum(a, b) < self.n) & (self.w[np.minimum(a, self.n)]
                                                       == self.w[np.minimum(b, self.n)])]
            out[live] += 1
        return out

    def of(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Common extension of the suffixes at ``i`` and ``j``, different places up to ``n``."""
        v = COVER[0]
        shift = SHIFTS[i % v, j % v]
        out = self._direct(i, j, shift)
        on = np.flatnonzero((out == shift) & (np.maximum(i, j) + shift < self.n))
        a, b = i[on] + shift[on], j[on] + shift[on]
        a, b = (self.rank[x // v * self.per + self.nth[x % v]] for x in (a, b))
        lo, hi = np.minimum(a, b), np.maximum(a, b)
        level = np.int64(np.log2(hi - lo)) if len(on) else lo
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            row = self.minima[k]
            out[on[at]] += np.minimum(row[lo[at]], row[hi[at] - (1 << int(k))])
        return out


def runs(ids: np.ndarray, min_length: int = MIN_LENGTH,
         min_exponent: int = MIN_EXPONENT) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every run, by start, then period.

    ``min_exponent`` is 3 at least, which makes a stretch with a multiple of its
    smallest period show under the smallest one, too.
    """
    if min_exponent < 3:
        raise ValueError("exponents from 3 on")
    n = len(ids)
    found: dict[tuple[int, int], int] = {}
    forwards = backwards = None
    top = n // min_exponent
    if n < min_length:
        return []
    periods = np.arange(1, top + 1)
    upto = np.cumsum((n - 1) // periods)  # grid pairs of the periods up to each
    first = 0
    while first < top:
        base = upto[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(upto, base + PAIRS, "right")))
        some = periods[first:last]
        count = (n - 1) // some
        first = last
        q = np.repeat(some, count)
        g = (np.arange(len(q)) - np.repeat(np.cumsum(count) - count, count)) * q
        # From a run's first grid point the text repeats for this many words at least.
        need = np.maximum((min_exponent - 2) * q + 1, min_length - 2 * q + 1)
        far = g + q + need - 1
        ok = far < n
        g, q, far, need = g[ok], q[ok], far[ok], need[ok]
        ok = ids[g] == ids[g + q]
        g, q, far, need = g[ok], q[ok], far[ok], need[ok]
        ok = ids[far - q] == ids[far]
        g, q, need = g[ok], q[ok], need[ok]
        if not len(g):
            continue
        forwards = forwards or Extensions(ids)
        ahead = forwards.of(g, g + q)
        ok = ahead >= need
        g, q, ahead = g[ok], q[ok], ahead[ok]
        # A grid point whose predecessor sees the same end is inside that one's run.
        inner = np.zeros(len(g), bool)
        inner[1:] = (g[1:] == g[:-1] + q[1:]) & (q[1:] == q[:-1]) & (ahead[:-1] == ahead[1:] + q[1:])
        g, q, ahead = g[~inner], q[~inner], ahead[~inner]
        if not len(g):
            continue
        backwards = backwards or Extensions(ids[::-1].copy())
        behind = np.zeros(len(g), np.int64)
        inside = np.flatnonzero(g > 0)
        behind[inside] = backwards.of(n - g[inside], n - g[inside] - q[inside])
        start, end = g - behind, g + q + ahead
        ok = end - start >= np.maximum(min_length, min_exponent * q)
        for s, e, p in zip(start[ok].tolist(), end[ok].tolist(), q[ok].tolist(), strict=True):
            found.setdefault((s, e), p)  # periods ascend: the first is the smallest
    return sorted((s, e - s, p) for (s, e), p in found.items())


def collapsed(tokens: list[bytes], found: list[tuple[int, int, int]]) -> bytes:
    """The words joined by one space, without those a run repeats."""
    if not found:
        return b" ".join(tokens)
    edge = np.zeros(len(tokens) + 1, np.int64)
    for start, length, period in found:
        edge[start + period] += 1
        edge[start + length] -= 1
    drop = np.cumsum(edge[:-1]) > 0
    return b" ".join(t for t, gone in zip(tokens, drop.tolist(), strict=True) if not gone)


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """``(doc_id, runs, collapsed)`` per row: the runs of the text's words, by start and
    period, and the text without the words that a run holds after its first period."""

    def run(rows: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {"doc_id": rows["doc_id"], "runs": [], "collapsed": []}
        for t in rows["text"]:
            tokens = (t or "").encode().split()  # ASCII white space only, as bytes
            names: dict[bytes, int] = {}
            ids = np.fromiter((names.setdefault(w, len(names)) for w in tokens), np.int64, len(tokens))
            found = runs(ids, min_length, min_exponent)
            out["runs"].append([dict(zip(("start", "length", "period"), x, strict=True)) for x in found])
            out["collapsed"].append(collapsed(tokens, found).decode())
        return out

    picked = docs.select(docs[f"`{doc_id}`"].cast("long").alias("doc_id"),
                         docs[f"`{text}`"].alias("text"))
    return map_rows(picked, run, f"doc_id long, runs {RUNS}, collapsed string")


def with_loops(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, text)`` where every tenth text, by the id's CRC-32, repeats a stretch of its
    words from some word on: known runs for the detector."""
    i, h = F.col("doc_id"), F.col("h")
    w, n, a = F.col("w"), F.size("w"), F.col("a")

    def loop(word: Column, at: Column) -> Column:
        return F.when(at < a, word).otherwise(F.get(w, (a + F.pmod(at - a, F.col("p"))).cast("int")))

    return (
        docs.select(docs[f"`{doc_id}`"].cast("long").alias("doc_id"),
                    docs[f"`{text}`"].alias("text"))
        .withColumn("h", F.crc32(i.cast("string")))
        .withColumn("g", F.floor(h / 10))
        .withColumn("w", F.when(F.pmod(h, F.lit(10)) == 0, words(F.col("text"))))
        .withColumn("a", F.when(n > 0, F.pmod(F.col("g"), n)))
        .withColumn("p", 1 + F.floor((n - a) / (3 + F.pmod("g", F.lit(8)))))
        .select("doc_id", F.when(n > 0, F.array_join(F.transform(w, loop), " "))
                .otherwise(F.col("text")).alias("text"))
    )


def run_report(found: DataFrame) -> DataFrame:
    """Digest columns of ``periodic_runs``: the count, the longest run, and SHA-256 sums."""
    best = F.array_min(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    length = -F.col("best.l")
    return (
        found.withColumn("best", best)
        .select("doc_id", F.size("runs").cast("long").alias("n_runs"),
                F.col("best.s").alias("start"), length.alias("length"),
                F.col("best.p").alias("period"),
                F.floor(1000 * length / F.col("best.p")).alias("exponent_milli"),
                F.sha2(lines, 256).alias("runs_sha256"),
                F.sha2("collapsed", 256).alias("collapsed_sha256"))
    )
