"""Chat formatting against the DuckDB oracle and by hand."""

from __future__ import annotations

import duckdb
from cases import prose

from trailspark.llm.chat import END, START, chats
from trailspark.llm.queries import oracle_sql

LOG = "conv_id long, turn long, role string, text string"


def log():
    rows = []
    for c in range(6):
        turns = [(("user", "assistant")[t % 2], prose(6, 10 * c + t)) for t in range(2 + c)]
        for snapshot in range(1, len(turns) + 1):  # every prefix is logged
            rows += [(100 * c + snapshot, t, *turns[t]) for t in range(snapshot)]
    rows += [(900 + i, t, "user", f"same {t}") for i in range(30) for t in range(3)]  # copies
    rows += [(950, 0, "user", "same 0"), (951, 0, "user", "same 0"), (951, 1, "user", "other")]
    rows += [(960, 0, None, None), (960, None, "user", "late"), (960, 0, None, None), (None, 0, "user", "x"),
             (961, 5, "user", "gap"), (961, 2, "assistant", "first"), (962, 0, "user", prose(20_000, 1))]
    return rows


def expected(rows):
    by = {}
    for c, t, r, x in rows:
        if c is not None:
            by.setdefault(c, []).append((t is None, t or 0, r or "", x or ""))
    turns = {c: tuple(x[2:] for x in sorted(v)) for c, v in by.items()}
    out = []
    for c, t in turns.items():
        if any(len(o) > len(t) and o[:len(t)] == t for o in turns.values()):
            continue
        same = [d for d, o in turns.items() if o == t]
        if c == min(same):
            out.append((c, len(t), len(same), "".join(f"{START}{r}\n{x}{END}\n" for r, x in t)))
    return sorted(out)


def test_maximal_conversations_match_brute_force(spark):
    table = spark.createDataFrame(log(), LOG).selectExpr("*", "1 AS place", "'x' AS h1", "2 AS n")
    assert sorted(tuple(r) for r in chats(table).collect()) == expected(log())
    assert chats(spark.createDataFrame([], LOG)).collect() == []


def test_oracle_gives_the_same(spark, tmp_path):
    spark.createDataFrame(log(), LOG).coalesce(1).write.parquet(str(tmp_path / "c"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/c/*.parquet')")
    res = con.execute(oracle_sql()["op9_chat"])
    at = [[d[0] for d in res.description].index(c) for c in ("conv_id", "n_turns", "copies", "chat")]
    assert sorted(tuple(r[i] for i in at) for r in res.fetchall()) == expected(log())
