"""Content-defined line chunks against a brute-force version, and what they promise."""

from __future__ import annotations

import random
from collections import defaultdict

import xxhash
from cases import edge_docs, frame, prose, rows_of

from trailspark.llm.line_chunks import dedup_chunks
from trailspark.llm.lines import dedup_runs

LAST = (1 << 63) - 1
BLANK = " \t\n\x0b\x0c\r"


def _signed(x):
    return x - (1 << 64) if x >> 63 else x


def _int(x):
    """Spark's xxhash64 treats an int as 4 bytes."""
    return x.to_bytes(4, "little")


def _xx(*values):
    """Spark's xxhash64 of texts, longs and bytes: each value's hash seeds the next."""
    h = 42
    for v in values:
        data = v.encode() if isinstance(v, str) else v if isinstance(v, bytes) else (
            v % (1 << 64)).to_bytes(8, "little")
        h = xxhash.xxh64_intdigest(data, h)
    return _signed(h)


def parts(text):
    """Lines, the numbers of those with a word, and each with the blank lines before it."""
    lines = text.split("\n")
    full = [i for i, x in enumerate(lines) if x.strip(BLANK)]
    tails = ["\n".join(lines[(full[k - 1] if k else -1) + 1:i + 1]) for k, i in enumerate(full)]
    return lines, full, [lines[i] for i in full], tails


def chunks(heads, tails):
    """``(a, b)`` of the content-defined chunks."""
    key = lambda t: (_xx(t), _xx(_int(1), t))
    r = [_xx(*key(heads[k]), *key(tails[k + 1])) for k in range(len(heads) - 1)]
    ends = [k for k in range(1, len(r) - 1) if r[k] < r[k - 1] and r[k] < r[k + 1]]
    return list(zip([0] + [e + 1 for e in ends], ends + [len(heads) - 1], strict=True)) if r else []


def brute(rows):
    """``(doc_id, text, n_removed)`` per row, the lines' numbers that go, and what justifies them."""
    docs, times = {}, defaultdict(int)
    for d, t, *_ in rows:
        if t is not None:
            key = (LAST if d is None else d, _xx(t))
            docs[key] = parts(t)
            times[key] += 1
    held = lambda key, a, b: (docs[key][2][a], *docs[key][3][a + 1:b + 1])

    def judged(found):  # of (key, a, b, may own, must have an owner)
        groups, count, needed = defaultdict(set), defaultdict(int), set()
        for key, a, b, own, need in found:
            groups[held(key, a, b)].add((*key, a, b, own))
            count[held(key, a, b)] += times[key]
            if need:
                needed.add(held(key, a, b))
        gone, owned, why = defaultdict(set), defaultdict(set), []
        for lines, occurrences in groups.items():
            owners = [o for o in occurrences if o[4]]
            if (count[lines] > 1 or lines in needed) and owners:
                first = min(owners)
                owned[first[:2]] |= set(range(first[2], first[3] + 1))
                for o in occurrences - {first}:
                    gone[o[:2]] |= set(range(o[2], o[3] + 1))
                    why.append((o, first))
        return gone, owned, why

    gone, owned, why = judged(
        [(key, a, b, True, False) for key, x in docs.items() for a, b in chunks(*x[2:])])
    gone = {k: gone[k] - owned[k] for k in docs}
    finer = [(key, a, a + 1, not {a, a + 1} & gone[key], {a, a + 1} <= owned[key]) for key, x in docs.items()
             for a in range(len(x[1]) - 1) if not {a, a + 1} <= gone[key]]
    more, kept2, why2 = judged(finer)
    total = {k: gone[k] | (more[k] - kept2[k]) for k in docs}
    out = []
    for d, t, *_ in rows:
        if t is None:
            out.append((d, None, 0))
            continue
        key = (LAST if d is None else d, _xx(t))
        lines, full, *_ = docs[key]
        kept = []
        for i, x in enumerate(lines):
            if i in full:
                beside = [full.index(i)]
            else:
                n = sum(f < i for f in full)
                beside = [k for k in (n - 1, n) if 0 <= k < len(full)]
            if not beside or not total[key].issuperset(beside):
                kept.append(x)
        out.append((d, "\n".join(kept), len(lines) - len(kept)))
    return sorted(out, key=repr), docs, total


def docs():
    passage, pair = prose(80, 77, 6), "two lines that\nstand in many texts"
    rows = [(400 + i, f"{prose(24, i, 6)}\n{passage}\n{prose(30, 50 + i, 6)}", "en", "s", 0) for i in range(6)]
    rows += [(500 + i, f"{prose(12, 900 + i, 6)}\n{pair}\n{prose(12, 950 + i, 6)}", "en", "s", 0) for i in range(9)]
    rows += [(600, "a\n\nb\nc", "en", "s", 0), (601, "\na\n\nb\n\n", "en", "s", 0),
             (602, "a\nb\nx\n \nb\nc\ny", "en", "s", 0), (603, "r\nr\nr\nr\nq\nr\nr", "en", "s", 0),
             (604, "u\nv\nu\nv\nu", "en", "s", 0), (605, "\n\n", "en", "s", 0), (606, "\n\n", "en", "s", 0),
             (607, "a\nq\nc", "en", "s", 0), (None, "r\nr\n\n\nu\nv", "en", "s", 0),
             (608, "a\nb\nx\n \nb\nc\ny", "en", "s", 0), (608, "other\nb\nc\ny", "en", "s", 0)]
    rng = random.Random(4)
    rows += [(700 + i, "\n".join(rng.choice("kmnop") for _ in range(rng.randrange(12))), "en", "s", 0)
             for i in range(40)]
    return rows + edge_docs()


def test_result_matches_brute_force(spark):
    got = dedup_chunks(frame(spark, docs(), clash=True)).collect()
    assert sorted(((r["doc_id"], r["text"], r["n_removed"] or 0) for r in got), key=repr) == brute(docs())[0]
    for r in got:
        assert sum(n for _, n in r["removed"] or ()) == (r["n_removed"] or 0)


def test_what_goes_stands_beside_its_neighbour_elsewhere():
    _, docs_, gone = brute(docs())
    standing = set()
    for key, (_, full, heads, tails) in docs_.items():
        standing |= {(heads[k], tails[k + 1]) for k in range(len(full) - 1)
                     if not {k, k + 1} & gone[key]}
    assert any(gone.values())
    for key, (_, full, heads, tails) in docs_.items():
        pairs = {k: (heads[k], tails[k + 1]) for k in range(len(full) - 1)}
        for k in gone[key]:
            assert pairs.get(k) in standing or pairs.get(k - 1) in standing


def test_chains_keep_the_run_that_justifies_the_next(spark):
    rows = [(0, "a\nb", "en", "s", 0), (1, "a\nb\nc", "en", "s", 0), (2, "b\nc\nd", "en", "s", 0)]
    got = {r["doc_id"]: r["text"].split("\n") for r in dedup_chunks(frame(spark, rows)).collect()}
    kept = [tuple(x[i:i + 2]) for x in got.values() for i in range(len(x) - 1)]
    for d, text, *_ in rows:
        lines = text.split("\n")
        for i in range(len(lines) - 1):
            if lines[i] not in got[d] and lines[i + 1] not in got[d]:
                assert (lines[i], lines[i + 1]) in kept


def test_every_shared_run_of_two_lines_goes(spark):
    rng = random.Random(9)
    rows, clean = [], {}
    for n in range(2, 15):
        passage = [f"passage {n} line {k} {rng.random()}" for k in range(n)]
        for i in range(4):
            fill = lambda: [f"own {rng.random()}" for _ in range(rng.randrange(6))]
            before, after = fill(), fill()
            rows.append((n * 10 + i, "\n".join([*before, *passage, *after]), "en", "s", 0))
            clean[n * 10 + i] = "\n".join([*before, *after]) if i else rows[-1][1]
    got = dedup_chunks(frame(spark, rows)).collect()
    assert {r["doc_id"]: r["text"] for r in got} == clean
    assert sum(r["n_removed"] - r["n_fine"] for r in got) > sum(r["n_fine"] for r in got)


def test_against_all_pairs_on_the_given_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    most = {r["doc_id"]: r["n_removed"] for r in dedup_runs(table).collect()}
    got = {r["doc_id"]: r["n_removed"] for r in dedup_chunks(table).collect()}
    assert sum(got.values()) > 0.9 * sum(most.values())


def test_empty_table_and_partitioning(spark):
    assert dedup_chunks(frame(spark, [])).collect() == []
    table = frame(spark, docs())
    assert rows_of(dedup_chunks(table.coalesce(1))) == rows_of(dedup_chunks(table.repartition(6)))


def test_texts_under_one_key_are_left_alone(spark, monkeypatch):
    from pyspark.sql import functions as F

    from trailspark.llm import line_chunks

    weak = lambda t: [F.xxhash64(F.length(t)).alias("k1"), F.lit(1).cast("long").alias("k2")]
    monkeypatch.setattr(line_chunks, "_key", weak)
    rows = [(1, "aa\nbbb\ncccc", "en", "s", 0), (2, "xx\nyyy\nzzzz", "en", "s", 0),
            (3, "12345\n123456\n1234567", "en", "s", 0), (4, "12345\n123456\n1234567", "en", "s", 0)]
    got = {r["doc_id"]: r["n_removed"] for r in dedup_chunks(frame(spark, rows)).collect()}
    assert got == {1: 0, 2: 0, 3: 0, 4: 3}
