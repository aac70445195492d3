"""Mixing against brute force: targets, quotas by highest quotients, taken words."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import pytest
from cases import edge_docs, frame, prose, rows_of

from trailspark.llm.common import settled
from trailspark.llm.mixing import (
    BLOCK_WORDS,
    SHARDS,
    _sized,
    _taken,
    mix,
    mixed_documents,
    quotas,
    targets,
)


def docs():
    out = []
    for s, n in (("b", 40), ("a", 15), ("c", 30), ("ü", 12), (None, 9), ("d", 50)):
        out += [(len(out) + i, prose(20 + 13 * i % 90, 31 * i + n), "en", s, 0) for i in range(n)]
    return out


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute_targets(rows):
    size = defaultdict(int)
    for _, t, _, s, _ in rows:
        size[s] += words(t)
    order = sorted((s for s in size if s is not None), key=lambda s: [ord(c) for c in s])
    order += [None] * (None in size)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    fixed, total = {}, 1.5 * sum(size.values())
    while True:
        rest = [s for s in order if s not in fixed]
        share = (total - sum(fixed.values())) / max(1, sum(weight[s] for s in rest))
        over = [s for s in rest if weight[s] * share > 2 * size[s]]
        if not over:
            break
        fixed |= {s: 2.0 * size[s] for s in over}
    return size, {s: fixed.get(s, weight[s] * share) for s in order}, order


def brute_quotas(target, order, house):
    seats = Counter()
    for _ in range(house):
        best = max(order, key=lambda s: (target[s] / (2 * seats[s] + 1), -order.index(s)))
        seats[best] += 1
    return seats


def test_targets_and_quotas(spark):
    rows = docs()
    size, target, order = brute_targets(rows)
    goals = settled(targets(settled(_sized(frame(spark, rows), "text", "source", "doc_id").drop("row"))))
    got = {r["source"]: r for r in goals.collect()}
    assert {s: r["source_size"] for s, r in got.items()} == dict(size)
    for s in order:
        assert got[s]["target"] == pytest.approx(target[s], rel=1e-12)
    seats = quotas(goals).collect()
    block = seats[0]["block"]
    assert block == max(1, min(BLOCK_WORDS, min(size.values()) // 100))
    house = round(sum(target.values()) / block)
    by = {(r["g"], r["shard"]): r["upto"] for r in seats}
    for k in range(SHARDS):
        expected = brute_quotas(target, order, house * (k + 1) // SHARDS)
        for s in order:
            assert by[got[s]["g"], k] == expected[s], (s, k)


def test_taken_words_follow_the_blocks(spark):
    rows = docs()
    sized = settled(_sized(frame(spark, rows), "text", "source", "doc_id").drop("row"))
    out = [r.asDict() for r in _taken(sized).collect()]
    for s in {r["source"] for r in out}:
        mine = sorted((r for r in out if r["source"] == s), key=lambda r: (
            r["bucket"], r["u"], r["id"], r["size"]))
        q, nb, b, first = (mine[0][c] for c in ("quota", "blocks", "block", "first"))
        times = [q // nb] * nb
        for k in range(q % nb):
            times[(first + k) % nb] += 1
        at = 0
        for r in mine:
            assert r["taken"] == sum(times[p // b] for p in range(at, at + r["size"]))
            at += r["size"]


def test_totals_come_near_the_targets(spark):
    rows = docs() + edge_docs()
    _, target, _ = brute_targets(rows)
    got = mix(frame(spark, rows, clash=True))
    assert len(got.collect()) == len(rows)
    taken, source = defaultdict(int), Counter()
    sizes = Counter((d, words(t), s) for d, t, _, s, _ in rows)
    for r in got.collect():
        assert 0 <= r["taken"] <= 2 * r["size"]
        source[r["doc_id"], r["size"]] += 1
        taken[round(r["target"], 6)] += r["taken"]
    assert source == Counter((d, n) for (d, n, _), k in sizes.items() for _ in range(k))
    for t in target.values():
        assert abs(taken[round(t, 6)] - t) <= max(2 * BLOCK_WORDS, 0.03 * t)
    assert rows_of(got) == rows_of(mix(frame(spark, rows, clash=True).repartition(5)))


def test_whole_documents_follow_the_mix(spark):
    docs_ = frame(spark, docs(), clash=True)
    out = mixed_documents(docs_)
    assert out.columns == docs_.columns
    copies = Counter(r["doc_id"] for r in out.select("doc_id").collect())
    assert max(copies.values()) <= 2
    for r in mix(docs_).collect():  # a block's edge lies in few documents
        assert abs(copies[r["doc_id"]] * r["size"] - r["taken"]) <= r["size"]


def test_repeated_rows_and_empty_tables(spark):
    rows = [(1, prose(300, 1), "en", "a", 0)] * 6 + docs()
    out = mixed_documents(frame(spark, rows)).collect()
    assert Counter(r["doc_id"] for r in out)[1] <= 14
    assert mix(frame(spark, [])).collect() == [] and mixed_documents(frame(spark, [])).collect() == []
    none = mix(frame(spark, [(1, None, None, None, None), (2, "", "en", "a", 0)])).collect()
    assert sorted((r["doc_id"], r["size"], r["taken"]) for r in none) == [(1, 0, 0), (2, 0, 0)]


def test_every_block_goes_to_the_shard_whose_quota_it_fills(spark):
    rows = docs() + [(1, prose(90, 1), "en", "a", 0)] * 5
    sized = settled(_sized(frame(spark, rows), "text", "source", "doc_id").drop("row"))
    goals = settled(targets(sized))
    seats = {(r["g"], r["shard"]): r["upto"] for r in quotas(goals).collect()}
    out = [r.asDict() for r in _taken(sized).collect()]
    assert len(out) == len(rows)
    words_of = Counter()
    for s in {r["source"] for r in out}:
        mine = sorted((r for r in out if r["source"] == s), key=lambda r: r["a"])
        nb, b, first, g = (mine[0][c] for c in ("blocks", "block", "first", "g"))
        times = [[0] * SHARDS for _ in range(nb)]  # of each block in each shard, dealt one by one
        j = 0
        for k in range(SHARDS):
            while j < seats[g, k]:
                times[(first + j) % nb][k] += 1
                j += 1
        at = 0
        for r in mine:
            assert r["a"] == at  # no gap and no overlap on the line
            expected = [sum(times[p // b][k] for p in range(at, at + r["size"])) for k in range(SHARDS)]
            assert r["by_shard"] == expected and r["taken"] == sum(expected)
            at += r["size"]
        for k in range(SHARDS):
            words_of[k] += sum(r["by_shard"][k] for r in mine)
    assert max(words_of.values()) - min(words_of.values()) <= len(goals.collect()) * 2 * BLOCK_WORDS


def test_copies_of_a_row_lie_in_many_buckets(spark, monkeypatch):
    from trailspark.llm import mixing

    monkeypatch.setattr(mixing, "BUCKET_ROWS", 8)
    monkeypatch.setattr(mixing, "GROUP", 4)
    rows = [(1, "a b c", "en", "hot", 0)] * 400 + docs()
    sized = settled(_sized(frame(spark, rows), "text", "source", "doc_id").drop("row"))
    out = [r for r in _taken(sized).collect() if r["source"] == "hot"]
    assert len(out) == 400 and len({r["bucket"] for r in out}) > 20
    assert sorted(r["a"] for r in out) == list(range(0, 1200, 3))


def test_whole_documents_miss_by_their_ends_only(spark):
    rows = docs()
    size, target, _ = brute_targets(rows)
    longest = defaultdict(int)
    for _, t, _, s, _ in rows:
        longest[s] = max(longest[s], words(t))
    got = defaultdict(int)
    for r in mixed_documents(frame(spark, rows)).collect():
        got[r["source"]] += words(r["text"])
    for s, t in target.items():
        assert abs(got[s] - t) <= 2 * longest[s] + 2 * BLOCK_WORDS
