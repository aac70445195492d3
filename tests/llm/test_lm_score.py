"""Language-model scores against a dictionary-based model, and the parts of the trie."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from cases import edge_docs, frame, prose

from trailspark.llm.elias_fano import STEPS, EliasFano, Trie, load, quantised, remove, save
from trailspark.llm.lm_score import SEED, lm_scores, packed, unpacked


def brute(rows, split):
    """``{row number: (doc_id, held, n_tokens, n_known, N, base, steps)}``."""
    texts = []
    for doc_id, text, *_ in rows:
        held = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2
        texts.append((doc_id, held, (text or "").encode().lower().split() + [b"</s>"]))
    c1 = Counter(w for _, held, ws in texts if not held for w in ws)
    n, v = sum(c1.values()), len(c1)

    def code(p):
        return int(quantised(np.log10(np.array([p])))[0])

    def code1(w):
        return int(quantised(np.log10(np.array([c1[w] + 1.0])) - math.log10(n + v + 1))[0])

    def grams(ws):
        for i in range(1, len(ws)):
            before = ws[i - 2] if i >= 2 else None
            classes = max(1, -(-c1[ws[i - 1]] // split))
            h = xxhash.xxh64_intdigest(before, SEED) if before is not None else 0
            yield (ws[i - 1], h % classes), before, ws[i]

    c2, c3, after1, after2 = Counter(), Counter(), defaultdict(set), defaultdict(set)
    s1, s2 = Counter(), Counter()
    for _, held, ws in texts:
        if not held:
            for m, b, w in grams(ws):
                c2[m, w] += 1
                c3[m, b, w] += 1
                s1[m] += 1
                s2[m, b] += 1
                after1[m].add(w)
                after2[m, b].add(w)

    def steps(m, b, w):
        t1, t2 = len(after1[m]), len(after2[m, b])
        lower = 10.0 ** (-code1(w) / STEPS)
        p2 = (c2[m, w] + t1 * lower) / (s1[m] + t1) if t1 else 0
        if c3[m, b, w]:
            return code((c3[m, b, w] + t2 * p2) / (s2[m, b] + t2))
        back2 = code(t2 / (s2[m, b] + t2)) if t2 else 0
        if c2[m, w]:
            return back2 + code(p2)
        return back2 + (code(t1 / (s1[m] + t1)) if t1 else 0) + code1(w)

    out = []
    for doc_id, held, ws in texts:
        base = sum(math.log10(c1[w] + 1) - math.log10(n + v + 1) for w in ws)
        total = code1(ws[0]) + sum(steps(*g) for g in grams(ws))
        out.append((doc_id, held, len(ws), sum(c1[w] > 0 for w in ws), n, base, total))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"],
                    r["base_score"], round(-r["score"] * STEPS)) for r in df.collect()), key=repr)


def assert_matches(df, rows, split):
    found, expected = got(df), brute(rows, split)
    key = lambda x: (repr(x[:5]), x[6])
    found, expected = sorted(found, key=key), sorted(expected, key=key)
    assert [(*x[:5], x[6]) for x in found] == [(*x[:5], x[6]) for x in expected]
    assert [x[5] for x in found] == pytest.approx([x[5] for x in expected], rel=1e-12)


def rows(seed=0, many=60):
    rng = random.Random(seed)
    out = [(100 + i, " ".join(rng.choices("a A b c d hot hot hot hot é x1".split(), k=rng.randrange(60))),
            "en", "s", 1) for i in range(many)]
    short = [r if r[0] != 5 else (5, prose(400, 2), "en", "b", 1) for r in edge_docs()]
    return out + short + [out[3], out[3]]


@pytest.mark.parametrize(("chunk", "shard", "split"), [(1 << 20, 1 << 20, 1 << 18), (300, 50, 12)])
def test_matches_dictionaries(spark, chunk, shard, split):
    df = lm_scores(frame(spark, rows(), clash=True), chunk_bytes=chunk, bucket_words=40,
                   shard_words=shard, split=split)
    assert_matches(df, rows(), split)


def test_little_input(spark):
    assert lm_scores(frame(spark, [])).collect() == []
    held = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 7 == 2)
    for few in ([(1, None, "en", "s", 1)], [(held, "a b c", "en", "s", 1)],
                [(held, "a b a b", "en", "s", 1), (1, "a b", "en", "s", 1)]):
        assert_matches(lm_scores(frame(spark, few)), few, 1 << 18)


def test_very_long_text(spark):
    few = [(1, prose(30_000, 8), "en", "s", 1), (2, prose(50, 8), "en", "s", 1)]
    assert_matches(lm_scores(frame(spark, few), chunk_bytes=1000, shard_words=5000), few, 1250)


def test_probabilities_after_a_context_add_up():
    rng = np.random.default_rng(4)
    seen = sorted({(k, b, w): 0 for k, b, w in rng.integers(0, 6, (300, 3)).tolist()})
    k, b, w = (np.array(x) for x in zip(*seen, strict=True))
    count = rng.integers(1, 9, len(k))
    p1 = rng.dirichlet(np.ones(7))
    arrays = Trie.build(k, b, w, count, p1[w])
    trie = Trie(arrays)
    words = np.arange(7)
    for context in [(0, 0), (3, 5), (2, 77), (99, 1)]:
        codes = trie.codes(np.full(7, context[0]), np.full(7, context[1]), words, quantised(np.log10(p1)))
        assert sum(10.0 ** (-codes / STEPS)) == pytest.approx(1, abs=2e-3)


def test_elias_fano():
    rng = np.random.default_rng(1)
    for n, top in ((0, 1), (1, 1), (1, 10**12), (50, 60), (1000, 10), (3000, 10**6), (500, 2**45)):
        x = np.sort(rng.integers(0, top, n))
        ef = EliasFano.build(x)
        assert ef.at(np.arange(n)).tolist() == x.tolist()
        q = np.concatenate([x, x + 1, rng.integers(0, top + 5, 200), [0, top * 2]]).astype(np.int64)
        assert ef.successor(q).tolist() == np.searchsorted(x, q).tolist()


def test_files_and_blobs(tmp_path):
    arrays = {"a": np.arange(5), "b": np.zeros(0, np.uint16), "c": np.array([7], np.uint64)}
    uri = f"file://{tmp_path}/x"
    save(arrays, uri)
    back = load(uri)
    assert {k: v.tolist() for k, v in back.items()} == {k: v.tolist() for k, v in arrays.items()}
    remove(uri)
    cols = [np.arange(1000), np.zeros(0, np.int64), np.array([2**62, 0, -1]).astype(np.int64)]
    assert [c.tolist() for c in unpacked(packed(*cols[:2]))] == [c.tolist() for c in cols[:2]]
    assert unpacked(packed(cols[2].view(np.uint64)))[0].tolist() == cols[2].tolist()


def test_held_out_texts_do_better_than_single_words(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    held = [r for r in lm_scores(docs).collect() if r["held_out"]]
    assert len(held) > 10
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_sizes_of_parts_change_no_score(spark):
    """A word that outgrows a shard keeps one shorter context, however its parts are cut."""
    for chunk, shard, part in ((1 << 20, 1 << 20, None), (300, 50, None), (300, 60, 3), (2000, 400, 1)):
        df = lm_scores(frame(spark, rows()), chunk_bytes=chunk, bucket_words=40, shard_words=shard,
                       part_words=part)
        assert_matches(df, rows(), 1 << 60)
