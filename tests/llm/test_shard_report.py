"""The shard report is made from the shards as they were written."""

from __future__ import annotations

import os
import zlib

from cases import frame, prose, rows_of

from trailspark.llm import sharding


def test_report_reads_the_written_shards(spark, tmp_path, monkeypatch):
    docs = [(i, prose(5 + i % 7, i), "en", "s", i) for i in range(200)]
    table = frame(spark, docs, clash=True)
    path = str(tmp_path / "shards")
    monkeypatch.setattr(sharding, "scratch_path", lambda *_: path, raising=False)
    got = sharding.shard_report(table).collect()
    assert {x for x in os.listdir(path) if x.startswith("shard=")} == {f"shard={k}" for k in range(8)}
    back = spark.read.parquet(path)
    assert rows_of(back.select(table.columns)) == rows_of(table)
    assert {(r["doc_id"], r["shard"], r["slot"], r["size"], r["text_crc32"]) for r in got} == {
        (r["doc_id"], r["shard"], r["slot"], len(r["text"].encode()) + 1, zlib.crc32(r["text"].encode()))
        for r in back.collect()}


def test_buckets_are_bounded_by_the_bytes_of_texts(spark):
    table = frame(spark, [(i, prose(2000, i), "en", "s", i) for i in range(40)])
    one, many = (sharding.shuffled(table, bucket_bytes=b) for b in (1 << 30, 1 << 14))
    assert rows_of(one.select("doc_id", "text")) == rows_of(many.select("doc_id", "text"))
    assert rows_of(one) != rows_of(many)
