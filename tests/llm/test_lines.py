"""Line dedup against a brute-force version in Python."""

from __future__ import annotations

import re
import struct
from collections import defaultdict

import xxhash
from cases import edge_docs, frame, prose, rows_of

from trailspark.llm.lines import DIVISOR, ROLL, dedup_lines


def _hash(data: bytes) -> int:
    return xxhash.xxh64_intdigest(data, 42)


def chunks(text):
    lines = text.split("\n")
    h = [_hash(x.encode()) for x in lines]
    rot = lambda x, k: (x << k | x >> (64 - k)) % (1 << 64) if k else x
    marks = []
    for i in range(len(h)):
        v = 0
        for k in range(ROLL):
            if i >= k:
                v ^= rot(h[i - k], k)
        signed = struct.unpack("<q", struct.pack("<q", _signed(_hash(struct.pack("<Q", v)))))[0]
        marks.append(signed % DIVISOR == 0)
    out, start = [], 0
    for i in range(len(lines)):
        if i == len(lines) - 1 or 1 <= i < len(lines) - 2 and marks[i] and not marks[i - 1]:
            out.append((start, lines[start:i + 1]))
            start = i + 1
    return out


def _signed(x):
    return x - (1 << 64) if x >> 63 else x


def brute(rows):
    last = (1 << 63) - 1
    removable = lambda c: sum(bool(re.search(r"[^ \t-\r]", x)) for x in c) >= 2
    seen = defaultdict(list)
    for i, (d, text, *_) in enumerate(rows):
        if text is not None:
            for at, c in chunks(text):
                if removable(c):
                    seen["\n".join(c)].append((last if d is None else d, i, at))
    out = []
    for i, (d, text, *_) in enumerate(rows):
        if text is None:
            out.append((d, None, 0))
            continue
        kept, own = [], set()
        for at, c in chunks(text):
            key = "\n".join(c)
            first = min(x for x, *_ in seen[key]) if removable(c) else None
            mine = last if d is None else d
            if first is None or not (mine > first or key in own):
                kept += c
            own.add(key)
        out.append((d, "\n".join(kept), len(text.split("\n")) - len(kept)))
    return sorted(out, key=repr)


def docs():
    passage = prose(80, 77, 6)
    rows = [(400 + i, f"{prose(24, i, 6)}\n{passage}\n{prose(30, 50 + i, 6)}", "en", "s", 0) for i in range(12)]
    rows += [(20 + i, prose(60, 3, 5), "en", "s", 0) for i in range(4)]
    rows += [(30, prose(18, 9, 3) + "\n" + prose(18, 9, 3), "en", "s", 0), (31, "\n\n\n\n", "en", "s", 0),
             (32, "\n\n\n\n", "en", "s", 0), (33, prose(500, 8, 4), "en", "s", 0)]
    return rows + edge_docs()


def test_result_matches_brute_force(spark):
    got = dedup_lines(frame(spark, docs(), clash=True)).collect()
    assert sorted(((r["doc_id"], r["text"], r["n_removed"] or 0) for r in got), key=repr) == brute(docs())


def test_shared_passage_is_found_at_any_offset(spark):
    got = {r["doc_id"]: r for r in dedup_lines(frame(spark, docs())).collect() if r["doc_id"]}
    for i in range(401, 412):
        assert got[i]["n_removed"] >= 6  # of 14 lines, the passage's inner chunks
    assert got[400]["n_removed"] == 0
    for i in range(21, 24):
        assert got[i]["text"] == ""
    assert got[20]["n_removed"] == 0


def test_empty_table_and_partitioning(spark):
    assert dedup_lines(frame(spark, [])).collect() == []
    table = frame(spark, docs())
    assert rows_of(dedup_lines(table.coalesce(1))) == rows_of(dedup_lines(table.repartition(6)))
