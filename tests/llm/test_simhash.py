"""SimHash against brute force: fingerprints, links, components, kept documents."""

from __future__ import annotations

import random
import re

import numpy as np
import xxhash
from cases import edge_docs, frame, prose

from trailspark.llm.components import components
from trailspark.llm.simhash import classes, drop_near_duplicates, links, near_duplicates


def brute_print(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def roots(nodes, pairs):
    parent = {x: x for x in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}


def close(prints):
    a = np.array(prints, "u8")
    return [(i, i + 1 + int(j)) for i in range(len(a))
            for j in np.nonzero(np.bitwise_count(a[i + 1:] ^ a[i]) <= 2)[0]]


def near_docs():
    rng, rows = random.Random(5), edge_docs()
    for k in range(8):
        w = prose(900, 50 + k).split()
        for c in range(6):
            v = list(w)
            for _ in range(c):
                v[rng.randrange(len(v))] = "changed"
            rows.append((100 + 10 * k + c, " ".join(v), "en", "s", 0))
    return rows


def test_fingerprints_and_components_match_brute_force(spark):
    rows = [r for r in near_docs() if r[0] is not None]
    prints = [brute_print(r[1]) for r in rows]
    linked = close(prints)
    assert any(prints[a] != prints[b] for a, b in linked)  # links between different texts
    at = roots(range(len(rows)), linked)
    least = {}
    for i, r in enumerate(rows):
        least[at[i]] = min(least.get(at[i], r[0]), r[0])
    expected = sorted((r[0], f"{prints[i]:016x}", least[at[i]]) for i, r in enumerate(rows))
    got = near_duplicates(frame(spark, rows, clash=True))
    assert sorted(tuple(r) for r in got.collect()) == expected


def test_links_of_dense_clusters(spark):
    rng = random.Random(9)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    prints = set()
    for _ in range(6):
        x = rng.getrandbits(64)
        for _ in range(60):
            y = x
            for _ in range(rng.randint(0, 3)):
                y ^= 1 << rng.randrange(64)
            prints.add(y)
    prints = sorted(prints)
    expected = {frozenset((signed(prints[a]), signed(prints[b]))) for a, b in close(prints)}
    got = links(spark.createDataFrame([(signed(x),) for x in prints], "fp long")).collect()
    assert {frozenset((r["u"], r["v"])) for r in got} == expected


def test_links_are_not_broadcast(spark):
    # 28 rows a class, which the planner takes for one: small in its eyes at any threshold.
    rng = random.Random(4)
    prints = [rng.getrandbits(63) for _ in range(200)]
    prints += [x ^ 5 for x in prints[:20]]
    found = links(spark.createDataFrame([(x,) for x in prints], "fp long"))
    assert {(r["u"], r["v"]) for r in found.collect()} == {
        (max(x, x ^ 5), min(x, x ^ 5)) for x in prints[:20]}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_components_of_paths_and_stars(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (300, 200)]
    expected = roots({x for p in pairs for x in p if p[0] != p[1]}, [p for p in pairs if p[0] != p[1]])
    got = components(spark.createDataFrame(pairs, "u long, v long")).collect()
    assert {r["node"]: r["root"] for r in got} == expected and len(got) == len(expected)


def test_one_document_of_each_group_stays(spark):
    rows = near_docs()
    docs = frame(spark, rows, clash=True)
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    got = near_duplicates(docs).collect()
    with_id = {r["component_id"] for r in got if r["component_id"] is not None}
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    assert sorted(i for i in ids if i is not None) == sorted(with_id)
    assert ids.count(None) == 1  # the one null id whose group has no other id


def test_empty_table_and_tables_without_links(spark):
    assert near_duplicates(frame(spark, [])).collect() == []
    assert drop_near_duplicates(frame(spark, [])).collect() == []
    lone = spark.createDataFrame([(5, 0), (6, 255)], "doc_id long, fp long")
    assert sorted((r["fp"], r["component_id"]) for r in classes(lone).collect()) == [(0, 5), (255, 6)]
