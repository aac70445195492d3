from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

SF = {
    "sf0.001": "/root/testdata/sf0.001",
    "sf0.01": "/root/testdata/sf0.01",
}


@pytest.fixture(scope="session")
def spark():
    from trailspark.runtime import local_session

    s = local_session("*", shuffle_partitions=8, app="trailspark-tests")
    yield s
    s.stop()


def collect_routes(df) -> dict[tuple[int, int], str]:
    return {(r["user_id"], r["session_id"]): r["route"] for r in df.collect()}


def collect_counts(df) -> dict[str, int]:
    return {r["route"]: r["count"] for r in df.collect()}
