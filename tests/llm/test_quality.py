"""Quality rules against a brute-force version: base counts, MCD distances, verdicts."""

from __future__ import annotations

import math
import re
from collections import defaultdict

import numpy as np
import xxhash
from cases import edge_docs, frame, prose, rows_of

from trailspark.llm.quality import (
    BINS,
    CUTOFF,
    LEAST,
    SCALE,
    SEED,
    STEPS,
    SUPPORT,
    _consistency,
    quality_filter,
    quality_report,
)


def base(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    n, found = len(w), defaultdict(list)
    for i in range(n - 4):
        found[tuple(w[i:i + 5])].append(i)
    covered = {i + k for at in found.values() if len(at) > 1 for i in at for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(covered), n < 10 or 100 * len(covered) > 20 * n), len(lines)


def _half(vector):
    """Spark's xxhash64 of an int and longs: each value's hash seeds the next."""
    h = xxhash.xxh64_intdigest(SEED.to_bytes(4, "little"), 42)
    for v in vector:
        h = xxhash.xxh64_intdigest(int(v).to_bytes(8, "little", signed=True), h)
    return h % 2 if h < 1 << 63 else (h - (1 << 64)) % 2


def distances(rows):
    """Squared distances per row index, by numpy over each language and source."""
    groups, out = defaultdict(list), {}
    for i, (_, text, lang, source, _) in enumerate(rows):
        b, _ = base(text)
        if not b[5]:
            w = re.findall(r"[^\x20\x09-\x0D]+", text)
            x = (math.log((b[1] + 250) / (b[0] + 50)), math.sqrt((b[2] + 0.5) / (b[1] + 50)),
                 (sum(len(k) <= 3 for k in w) + 10) / (b[0] + 50),
                 math.log((len(set(w)) + 50) / (b[0] + 50)) / math.log((b[0] + 100) / 50))
            half_up = [math.floor(abs(v) * SCALE + 0.5) * (1 if v >= 0 else -1) for v in x]
            groups[lang, source].append((i, half_up))
    middle = lambda x: np.sort(x, axis=0)[(len(x) - 1) // 2]
    vectors = {g: np.array([v for _, v in members], float) for g, members in groups.items()}
    away = np.concatenate([np.abs(x - middle(x)) for x in vectors.values()])
    floor = (1.4826 * middle(away) + LEAST * SCALE) ** 2
    scatter = lambda x: np.cov(x.T, bias=True) * _consistency() + np.diag(floor)
    for g, members in groups.items():
        x = vectors[g]
        mad = middle(np.abs(x - middle(x)))
        starts = [(middle(x), np.diag((1.4826 * mad) ** 2 + floor))]
        halves = np.array([_half(v) for v in x])
        starts += [(x[halves == k].mean(axis=0), scatter(x[halves == k])) for k in (0, 1) if (halves == k).any()]
        best = None
        for centre, cov in starts:
            for _ in range(STEPS):
                d = np.einsum("ij,jk,ik->i", x - centre, np.linalg.inv(cov), x - centre)
                bins = np.floor(np.log2(np.maximum(d, 1e-6)) * BINS)
                last = np.sort(bins)[math.ceil(len(x) * SUPPORT) - 1]
                near = x[bins <= last]
                centre, cov = near.mean(axis=0), scatter(near)
            volume = round(np.linalg.slogdet(cov)[1] / 2, 8)
            if best is None or volume < best[0]:
                best = (volume, centre, cov)
        _, centre, cov = best
        d = np.einsum("ij,jk,ik->i", x - centre, np.linalg.inv(cov), x - centre)
        out |= {i: v for (i, _), v in zip(members, d, strict=True)}
    return out


def some_docs():
    rows = [(i, prose(40 + 7 * i, i), "en" if i % 3 else "de", "s" if i % 2 else None, 0)
            for i in range(60)]
    rows += [(100 + i, " ".join(x + "###" for x in prose(60, 90 + i).split()), "en", "s", 0)
             for i in range(4)]
    rows += [(200, "a b c d e f " * 30, "en", "s", 0), (201, prose(30, 5) + "\n" + prose(30, 5), "en", "s", 0)]
    return rows


def test_base_counts_and_distances_match_brute_force(spark):
    rows = [(i, *r[1:]) for i, r in enumerate(some_docs() + edge_docs())]
    expected = distances(rows)
    for r in quality_report(frame(spark, rows)).collect():
        counts = base(rows[r["doc_id"]][1])[0]
        assert tuple(r)[1:7] == counts
        if counts[5]:
            assert not r["kept"]
        else:
            assert math.isclose(r["distance2"], expected[r["doc_id"]], rel_tol=1e-6, abs_tol=1e-6)
            assert r["kept"] == (r["distance2"] <= CUTOFF)


def test_clean_texts_stay_and_symbol_junk_goes(spark):
    got = {r["doc_id"]: r["kept"] for r in quality_report(frame(spark, some_docs())).collect()}
    assert all(got[i] for i in range(60))
    assert not any(got[100 + i] for i in range(4)) and not got[200]


def test_labels_of_the_test_table(spark):
    d = "/root/testdata/sf0.001"
    got = quality_report(spark.read.parquet(f"{d}/documents.parquet"))
    labels = spark.read.parquet(f"{d}/labels.parquet")
    rows = got.join(labels, "doc_id").select("quality", "kept", "base_failed").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1 and not r["base_failed"]]
    assert all(good) and len(good) > 30


def test_filter_keeps_columns_and_agrees_with_the_report(spark):
    docs = frame(spark, some_docs() + edge_docs(), clash=True)
    kept = quality_filter(docs)
    assert kept.columns == docs.columns
    report = quality_report(docs).where("kept")
    assert rows_of(kept.select("doc_id")) == rows_of(report.select("doc_id"))


def test_empty_table(spark):
    assert quality_report(frame(spark, [])).collect() == []
    assert quality_filter(frame(spark, [])).collect() == []


def test_result_does_not_depend_on_the_partitioning(spark):
    docs = frame(spark, some_docs())
    one, many = quality_report(docs.coalesce(1)), quality_report(docs.repartition(9))
    assert rows_of(one) == rows_of(many)


def test_scatter_comes_from_the_data(spark):
    """The same odd text is an outlier among uniform texts and none among varied ones."""
    def group(source, spread):
        rows = []
        for i in range(120):
            long = (i * spread) % 12
            rows.append((1000 * spread + i, " ".join(
                f"{x}{'xyz' * (long // 3)}" for x in prose(60, 7000 + i).split()), "en", source, 0))
        return rows

    rows = group("uniform", 0) + group("varied", 5)
    rows += [(901, " ".join(f"{x}xyzxyz" for x in prose(60, 901).split()), "en", "uniform", 0),
             (902, " ".join(f"{x}xyzxyz" for x in prose(60, 901).split()), "en", "varied", 0)]
    got = {r["doc_id"]: r for r in quality_report(frame(spark, rows)).collect()}
    assert got[901]["distance2"] > 5 * got[902]["distance2"]
    assert not got[901]["kept"] and got[902]["kept"]


def test_labelled_rows_at_the_next_size(spark):
    d = "/root/testdata/sf0.01"
    got = quality_report(spark.read.parquet(f"{d}/documents.parquet"))
    labels = spark.read.parquet(f"{d}/labels.parquet")
    rows = got.join(labels, "doc_id").select("quality", "kept", "base_failed").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1 and not r["base_failed"]]
    bad = [r["kept"] for r in rows if r["quality"] == 0 and not r["base_failed"]]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.1 * len(bad)
