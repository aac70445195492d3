"""Runtime helpers: shared checkpoint folder, written intermediate tables."""

from __future__ import annotations

from pathlib import Path

from trailspark.runtime import ensure_checkpoint_dir, remove_path, scratch_path


def test_checkpoint_dir_comes_from_the_session(spark):
    d = ensure_checkpoint_dir(spark)
    assert d and d == spark.sparkContext.getCheckpointDir()


def test_scratch_paths_are_fresh_and_under_the_checkpoint_dir(spark):
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b
    base = ensure_checkpoint_dir(spark).removeprefix("file:")
    assert a.removeprefix("file:").startswith(base.rstrip("/"))


def test_removed_tables_are_gone(spark):
    path = scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    local = Path(path.removeprefix("file:"))
    assert local.exists()
    remove_path(spark, path)
    assert not local.exists()
