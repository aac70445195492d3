"""Two-pass shuffle: one law, gapless slots, Fisher-Yates order, repeated rows."""

from __future__ import annotations

import zlib
from collections import Counter

from cases import edge_docs, frame, prose, rows_of
from pyspark.sql import functions as F

from trailspark.llm.sharding import _fisher_yates, shard_report, shuffled, write_shards


def docs():
    return [(i, prose(5 + i % 7, i), "en", "s", i) for i in range(300)]


def check_shards(rows, shards=8):
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    counts = [len(slots.get(k, [])) for k in range(shards)]
    assert max(counts) - min(counts) <= 1
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))


def test_report_over_edge_rows(spark):
    rows = docs() + edge_docs()
    got = shard_report(frame(spark, rows, clash=True)).collect()
    check_shards(got)
    expected = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()))
                       for d, t, *_ in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == expected
    assert {r["law"] for r in got} == {"rows"} and {r["grown_shard"] for r in got} == {None}


def test_fisher_yates_against_swaps_in_python(spark):
    table = spark.range(1, 60).select("id", F.col("id").cast("int").alias("n"))
    draws = table.select("n", F.transform(
        F.sequence(F.lit(1), F.col("n")),
        lambda i: F.pmod(F.xxhash64(F.lit(7), F.col("id"), i.cast("int")), i + 1).cast("int")).alias("j"))
    expected = {}
    for r in draws.collect():
        a = list(range(r["n"]))
        for i in range(r["n"] - 1, 0, -1):
            j = r["j"][i - 1]
            a[i], a[j] = a[j], a[i]
        expected[r["n"]] = a
    got = table.select("n", _fisher_yates(F.col("n"), F.lit(7), F.col("id")).alias("a")).collect()
    assert {r["n"]: r["a"] for r in got} == expected


def test_order_is_random_and_independent_of_the_partitioning(spark):
    table = frame(spark, docs())
    one = shuffled(table.coalesce(1), bucket_rows=20)
    assert rows_of(one) == rows_of(shuffled(table.repartition(7), bucket_rows=20))
    order = [r["doc_id"] for r in sorted(one.collect(), key=lambda r: (r["slot"], r["shard"]))]
    assert order != sorted(order) and sorted(order) == list(range(300))
    assert rows_of(shuffled(table, seed=1)) != rows_of(shuffled(table, seed=2))


def test_repeated_records_scatter_and_all_stay(spark):
    rows = [(1, "same", "en", "s", 4)] * 200 + docs()[:100]
    got = shuffled(frame(spark, rows, clash=True), bucket_rows=25)
    assert got.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
    check_shards(got.collect())
    assert Counter(r["doc_id"] for r in got.collect())[1] == 201


def test_written_shards_hold_everything(spark, tmp_path):
    table = frame(spark, docs())
    write_shards(table, str(tmp_path / "shards"), shards=4)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert sorted(p.name for p in (tmp_path / "shards").iterdir() if p.is_dir()) == [
        f"shard={k}" for k in range(4)]
    assert rows_of(back.select(table.columns)) == rows_of(table)


def test_empty_table(spark):
    assert shard_report(frame(spark, [])).collect() == []


def test_clashing_columns_give_way(spark):
    table = frame(spark, docs()[:40]).selectExpr("*", "'x' AS shard", "7 AS slot")
    got = shuffled(table, bucket_rows=9)
    check_shards(got.collect())
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "shard", "slot"]
    assert rows_of(got) == rows_of(shuffled(table.drop("shard", "slot"), bucket_rows=9))
    check_shards(shard_report(table).collect())


def test_many_copies_are_made_block_by_block(spark, monkeypatch):
    from trailspark.llm import sharding

    rows = [(1, "same", "en", "s", 4)] * 137 + [(2, "twice", "en", "s", 4)] * 2 + docs()[:20]
    table = frame(spark, rows)
    whole = rows_of(shuffled(table, bucket_rows=30))
    monkeypatch.setattr(sharding, "COPIES", 10)
    assert rows_of(shuffled(table, bucket_rows=30)) == whole


def brute_order(spark, table, seed, buckets):
    """The order of all records from the rule, with Spark's hash only: buckets in turn, each
    sorted by hash and shuffled by swaps."""
    held = {}
    digests = table.select("doc_id", *[F.xxhash64(F.lit(seed + k), F.struct(*table.columns))
                                       for k in (1, 2)]).collect()
    copies = Counter()
    for doc_id, d1, d2 in digests:
        copies[d1, d2] += 1
        held.setdefault((doc_id, d1, d2), []).append(copies[d1, d2])
    rows = spark.createDataFrame([(i, a, b, c) for (i, a, b), cs in held.items() for c in cs],
                                 "id long, d1 long, d2 long, copy long")
    rows = rows.withColumn("h", F.xxhash64(F.lit(seed), "d1", "d2", "copy")).withColumn(
        "b", F.pmod("h", F.lit(buckets))).collect()
    order = []
    for b in range(buckets):
        mine = sorted((r["h"], r["copy"], r["id"]) for r in rows if r["b"] == b)
        for i in range(len(mine) - 1, 0, -1):
            j = spark.range(1).select(F.pmod(F.xxhash64(
                F.lit(seed), F.lit(b).cast("long"), F.lit(i)), F.lit(i + 1))).first()[0]
            mine[i], mine[j] = mine[j], mine[i]
        order += [x[2] for x in mine]
    return order


def test_whole_order_against_the_rule(spark):
    rows = [(1, "same", "en", "s", 4)] * 9 + docs()[:25]
    table = frame(spark, rows)
    got = sorted(shuffled(table, shards=3, seed=5, bucket_rows=10).collect(),
                 key=lambda r: (r["slot"], r["shard"]))
    assert [r["doc_id"] for r in got] == brute_order(spark, table, 5, 4)
