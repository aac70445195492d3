"""Hand-written inputs and expected answers (FIXTURES.md)."""

from __future__ import annotations

HEADER = ["user_id", "session_id", "event_type", "event_page", "timestamp"]

# Worked example of the task statement: 17 rows, two sessions.
WORKED = [
    (562, 507, "page", "main", 1620494781),
    (562, 507, "event", "main", 1620494788),
    (562, 507, "event", "main", 1620494798),
    (562, 507, "page", "family", 1620494820),
    (562, 507, "event", "family", 1620494828),
    (562, 507, "page", "main", 1620494848),
    (562, 507, "wNaxLlerrorU", "main", 1620494865),
    (562, 507, "event", "main", 1620494873),
    (562, 507, "page", "news", 1620494875),
    (562, 507, "page", "tariffs", 1620494876),
    (562, 507, "event", "tariffs", 1620494884),
    (562, 514, "page", "main", 1620728918),
    (562, 514, "event", "main", 1620729174),
    (562, 514, "page", "archive", 1620729674),
    (562, 514, "page", "bonus", 1620729797),
    (562, 514, "page", "tariffs", 1620731090),
    (562, 514, "event", "tariffs", 1620731187),
]
WORKED_ROUTES = {(562, 507): "main-family-main", (562, 514): "main-archive-bonus-tariffs"}

# Edge sessions; the tie-break ``seq`` is the line number (1-based).
EDGE = [
    (1, 1, "page", "A", 1),
    (1, 1, "page", "B", 2),
    (1, 1, "zERRORz", "B", 2),
    (1, 1, "page", "C", 3),
    (2, 1, "error", "A", 1),
    (2, 1, "page", "B", 2),
    (3, 1, "event", "A", 1),
    (3, 1, "custom", "B", 2),
    (4, 1, "page", "A", 1),
    (4, 1, "page", "A", 2),
    (4, 1, "event", "A", 3),
    (5, 1, "page", "A", 1),
    (5, 1, "page", "B", 2),
    (5, 1, "page", "A", 2),
    (5, 1, "page", "C", 3),
    (6, 1, "page", "A", 1),
    (6, 2, "page", "C", 2),
    (6, 1, "page", "B", 3),
    (7, 1, "page", "C", 3),
    (7, 1, "page", "A", 1),
    (7, 1, "page", "B", 2),
    (8, 1, "page", "A", 1),
    (8, 1, "xErRoRx", "A", 3),
    (8, 1, "page", "B", 2),
    (8, 1, "ferror", "C", 5),
    (8, 1, "page", "D", 4),
    (9, 1, "anerror", "A", 1),
]
EDGE_ROUTES_SEQ = {
    (1, 1): "A",
    (3, 1): "A-B",
    (4, 1): "A",
    (5, 1): "A-B-A-C",
    (6, 1): "A-B",
    (6, 2): "C",
    (7, 1): "A-B-C",
    (8, 1): "A-B",
}
# Without ``seq`` the tie inside session (5, 1) goes by page name.
EDGE_ROUTES_PAGE = {**EDGE_ROUTES_SEQ, (5, 1): "A-B-C"}
EDGE_COUNTS_SEQ = {"A-B": 3, "A": 2, "A-B-A-C": 1, "A-B-C": 1, "C": 1}

# Malformed lines, all rejected: empty page, short, long, bad number, bad id.
MALFORMED = [
    "1\t1\tpage\t\t10",
    "1\t1\tpage\tx",
    "1\t1\tpage\tx\t11\textra",
    "1\t1\tpage\tx\tbad",
    "x\t1\tpage\tx\t12",
]
VALID_LINE = "1\t1\tpage\tok\t5"


def tsv(rows, with_seq: bool = False) -> str:
    header = HEADER + (["seq"] if with_seq else [])
    lines = ["\t".join(header)]
    for i, r in enumerate(rows, start=1):
        fields = [str(v) for v in r] + ([str(i)] if with_seq else [])
        lines.append("\t".join(fields))
    return "\n".join(lines) + "\n"


def write(tmp_path, name: str, text: str) -> str:
    p = tmp_path / name
    p.write_text(text)
    return str(p)
