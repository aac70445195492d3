"""Per-stage shuffle-read balance from a Spark event log (no UI needed).

Usage: python tools/task_balance.py <spark.eventLog.dir>

Prints, for each stage that read shuffle data, the job group, task count and
the largest / median / total records read per task, and the longest task.
"""

from __future__ import annotations

import collections
import json
import sys
from pathlib import Path


def _lines(path: Path):
    raw = path.read_bytes()
    if path.suffix == ".zstd":
        import zstandard

        raw = zstandard.ZstdDecompressor().stream_reader(raw).read()
    return raw.decode().splitlines()


def main(log_dir: str) -> None:
    group: dict[int, str | None] = {}
    tasks: dict[int, list[tuple[int, int]]] = collections.defaultdict(list)
    for path in sorted(Path(log_dir).rglob("*")):
        if not path.is_file() or path.name.startswith(".") or "appstatus" in path.name:
            continue
        for line in _lines(path):
            e = json.loads(line)
            kind = e["Event"]
            if kind == "SparkListenerJobStart":
                g = (e.get("Properties") or {}).get("spark.jobGroup.id")
                for sid in e["Stage IDs"]:
                    group[sid] = g
            elif kind == "SparkListenerTaskEnd" and e.get("Task Metrics"):
                m = e["Task Metrics"]
                read = m.get("Shuffle Read Metrics", {}).get("Total Records Read", 0)
                info = e["Task Info"]
                tasks[e["Stage ID"]].append((read, info["Finish Time"] - info["Launch Time"]))
    for sid in sorted(tasks):
        reads = sorted(r for r, _ in tasks[sid])
        if reads[-1] == 0:
            continue
        longest = max(d for _, d in tasks[sid])
        print(f"{group.get(sid)!s:10s} stage {sid:4d} tasks {len(reads):5d} "
              f"read max {reads[-1]:10d} median {reads[len(reads) // 2]:10d} "
              f"total {sum(reads):11d} longest {longest} ms")


if __name__ == "__main__":
    main(sys.argv[1])
