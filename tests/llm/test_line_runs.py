"""Every run of whole lines that an earlier document holds goes, by brute force."""

from __future__ import annotations

from cases import edge_docs, frame, prose, rows_of

from trailspark.llm.lines import dedup_runs

LAST = (1 << 63) - 1


def brute(rows):
    """``(doc_id, text, n_removed)`` from sets of pairs of successive lines with a word."""
    def pairs(lines):
        full = [i for i, x in enumerate(lines) if x.strip(" \t\n\x0b\x0c\r")]
        return full, ["\n".join(lines[a:b + 1]) for a, b in zip(full, full[1:])]

    ids = lambda d: LAST if d is None else d
    first = {}
    for d, t, *_ in rows:
        for p in pairs(t.split("\n"))[1] if t is not None else ():
            first[p] = min(first.get(p, LAST), ids(d))
    out = []
    for d, t, *_ in rows:
        if t is None:
            out.append((d, None, 0))
            continue
        lines = t.split("\n")
        full, own = pairs(lines)
        gone, seen = set(), {}
        for k, p in enumerate(own):
            if first[p] < ids(d):
                gone |= {k, k + 1}
            elif p in seen:
                gone |= {k, k + 1} - {seen[p], seen[p] + 1}
            seen.setdefault(p, k)
        kept = []
        for i, x in enumerate(lines):
            if i in full:
                beside = [full.index(i)]
            else:
                beside = [k for k in (sum(f < i for f in full) - 1, sum(f < i for f in full)) if 0 <= k < len(full)]
            if not beside or not gone.issuperset(beside):
                kept.append(x)
        out.append((d, "\n".join(kept), len(lines) - len(kept)))
    return sorted(out, key=repr)


def docs():
    passage = prose(80, 77, 6)
    pair = "two lines that\nstand in many texts"
    rows = [(400 + i, f"{prose(24, i, 6)}\n{passage}\n{prose(30, 50 + i, 6)}", "en", "s", 0) for i in range(6)]
    rows += [(500 + i, f"{prose(12, 900 + i, 6)}\n{pair}\n{prose(12, 950 + i, 6)}", "en", "s", 0) for i in range(9)]
    rows += [(600, "a\n\nb\nc", "en", "s", 0), (601, "\na\n\nb\n\n", "en", "s", 0),
             (602, "a\nb\nx\n \nb\nc\ny", "en", "s", 0), (603, "r\nr\nr\nr\nq\nr\nr", "en", "s", 0),
             (604, "u\nv\nu\nv\nu", "en", "s", 0), (605, "\n\n", "en", "s", 0), (606, "\n\n", "en", "s", 0),
             (607, "a\nq\nc", "en", "s", 0), (None, "r\nr\n\n\nu\nv", "en", "s", 0)]
    return rows + edge_docs()[:5] + edge_docs()[6:]


def test_result_matches_brute_force(spark):
    got = dedup_runs(frame(spark, docs(), clash=True)).collect()
    assert sorted(((r["doc_id"], r["text"], r["n_removed"] or 0) for r in got), key=repr) == brute(docs())
    for r in got:
        assert sum(n for _, n in r["removed"] or ()) == (r["n_removed"] or 0)


def test_short_runs_and_the_edges_of_passages_go(spark):
    got = {r["doc_id"]: r for r in dedup_runs(frame(spark, docs())).collect()}
    assert got[400]["n_removed"] == got[500]["n_removed"] == 0
    for i in range(1, 6):
        assert got[400 + i]["text"] == f"{prose(24, i, 6)}\n{prose(30, 50 + i, 6)}"
    for i in range(1, 9):
        assert got[500 + i]["text"] == f"{prose(12, 900 + i, 6)}\n{prose(12, 950 + i, 6)}"


def test_empty_table_and_partitioning(spark):
    assert dedup_runs(frame(spark, [])).collect() == []
    table = frame(spark, docs())
    assert rows_of(dedup_runs(table.coalesce(1))) == rows_of(dedup_runs(table.repartition(6)))
