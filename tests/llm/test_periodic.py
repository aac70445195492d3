"""Periodic runs against direct definitions."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from cases import edge_docs, frame, prose, rows_of

from trailspark.llm.periodic import (
    Extensions,
    collapsed,
    cover_shifts,
    periodic_runs,
    run_report,
    runs,
    with_loops,
)


def brute_runs(w, min_length=6, min_exponent=4):
    n, found = len(w), {}
    for q in range(1, n // min_exponent + 1):
        s = 0
        while s + q < n:
            e = s + q
            while e < n and w[e] == w[e - q]:
                e += 1
            if e - s >= max(min_length, min_exponent * q):
                found.setdefault((s, e), q)
            s = max(s + 1, e - q + 1)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def brute_row(doc_id, text):
    w = (text or "").encode().split()
    h, n = zlib.crc32(str(doc_id).encode()) if doc_id is not None else None, len(w)
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    found = brute_runs(w)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    best = min(((-length, s, q) for s, length, q in found), default=None)
    told = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *told, hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(kept).hexdigest())


def sequences(seed, count):
    rng = random.Random(seed)
    for _ in range(count):
        w = [rng.randrange(rng.choice((1, 2, 3, 50))) for _ in range(rng.randrange(0, 120))]
        for _ in range(rng.randrange(3)):
            at, q, k = rng.randrange(len(w) + 1), rng.randrange(1, 9), rng.randrange(2, 9)
            w[at:at] = [rng.randrange(4) for _ in range(q)] * k
        yield np.array(w, np.int64)


def test_extensions_match_direct_comparison():
    rng = random.Random(5)
    for w in sequences(1, 150):
        n = len(w)
        if n < 2:
            continue
        got = Extensions(w)
        pairs = [p for p in ((rng.randrange(n), rng.randrange(n)) for _ in range(60)) if p[0] != p[1]]
        if not pairs:
            continue
        i, j = (np.array(x) for x in zip(*pairs, strict=True))
        expected = []
        for a, b in pairs:
            k = 0
            while max(a, b) + k < n and w[a + k] == w[b + k]:
                k += 1
            expected.append(k)
        assert got.of(i, j).tolist() == expected


def test_runs_match_the_definition():
    for w in sequences(2, 400):
        assert runs(w) == brute_runs(w.tolist())
        assert runs(w, 3, 3) == brute_runs(w.tolist(), 3, 3)
    with pytest.raises(ValueError):
        runs(np.zeros(9, np.int64), 3, 2)
    with pytest.raises(ValueError):
        cover_shifts(7, (0, 1))


def test_long_texts():
    same = np.zeros(60_000, np.int64)
    assert runs(same) == [(0, 60_000, 1)]
    block = np.random.default_rng(3).permutation(9_000)
    w = np.concatenate([[9_001], np.tile(block, 5), [9_002]]).astype(np.int64)
    assert runs(w) == [(1, 45_000, 9_000)]


def test_collapse_keeps_the_first_period():
    w = "x a b a b a b a b a y".split()
    ids = np.unique(w, return_inverse=True)[1]
    found = runs(ids)
    assert found == [(1, 9, 2)]
    assert collapsed([x.encode() for x in w], found) == b"x a b y"


def test_query_rows_match_brute_force(spark):
    rows = edge_docs() + [(i, prose(30 + i, i), "en", "s", 1) for i in range(100, 160)]
    rows += [(i, "la " * 40 + prose(20, i), "en", "s", 1) for i in (200, 201, 201)]
    got = run_report(periodic_runs(with_loops(frame(spark, rows, clash=True))))
    assert rows_of(got) == sorted((brute_row(r[0], r[1]) for r in rows), key=repr)
    assert got.count() == len(rows) and sum(r[1] > 0 for r in got.select("doc_id", "n_runs").collect()) > 3
    assert rows_of(run_report(periodic_runs(with_loops(frame(spark, []))))) == []
