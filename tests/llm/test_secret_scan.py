"""Secret scan: base spans from the contract's patterns, ownership classes by brute force."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

from cases import edge_docs, frame, prose

from trailspark.llm.secret_scan import MANY_OWNERS, base_digest, candidates, secret_report

KEY = "AKIA" + "Q7ZP" * 4
HEXES = ["0123456789abcdef" * 2, "deadbeefcafe" * 3]
MIXED = "aB3dE5fG7hJ9kL1mN3pQ5rS7tU9vW1xY3"


def brute_base(text):
    """The contract, pattern by pattern, with the failing matches dropped afterwards."""
    text = text or ""
    flags = re.ASCII | re.IGNORECASE
    assign = re.compile(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", flags)
    spans = [(m.start(), 0, "assign", m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text)
              if len(m[0]) >= 20]
    spans += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(k, s, e) for s, _, k, e in sorted(spans)]


def docs():
    out = edge_docs()
    for i in range(12):
        a, b = f"token = \"{HEXES[0]}\"", f"id {HEXES[1]}{i:x}{i:x}"
        out.append((100 + i, f"é\U0001f600 {prose(8, i)} {a} {b} {KEY if i % 3 else ''}", "en", f"s{i % 4}", 0))
    out += [
        (200, f"Password:'hunter2hunter' api_key=abc secret=token = abcdefgh {MIXED}", "en", "own", 0),
        (201, f"toKEN=token=abcdefgh APIKEY : \"x{MIXED}\" {MIXED}", "en", "own", 0),
        (202, "ſecret=abcdefgh toKen=abcdefgh AKIASHORT AKIAAKIA" + "X" * 16, "en", "own", 0),
        (203, "0" * 40 + " token=" + "a" * 30, "en", "own", 0),
        (204, "token=\n abcdefgh passwd == abcdefgh secret'=\"abc.def/ghi=\"", "en", None, 0),
    ]
    return out


def test_base_spans_and_digest_match_the_contract(spark):
    got = defaultdict(list)
    for r in secret_report(frame(spark, docs(), clash=True)).collect():
        got[r["doc_id"]].append(r)
    for d, text, *_ in docs():
        if d is None:
            continue
        spans = brute_base(text)
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        for r in got[d]:
            kinds = [k for k, *_ in spans]
            assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(
                map(kinds.count, ("assign", "access", "hex"))), d
            assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest() == base_digest(text)
            assert set(joined.split(",")) - {""} <= set(r["spans"].split(","))
    assert sum(map(len, got.values())) == len(docs())


def test_ownership_separates_copied_examples_from_live_ones(spark):
    rows = docs()
    owners = defaultdict(set)
    for _, text, _, source, _ in rows:
        for *_, value in candidates(text):
            owners[value].add(source)
    got = {r["doc_id"]: r for r in secret_report(frame(spark, rows)).collect()}
    assert len(owners[HEXES[0]]) == 4 and len(owners[MIXED]) == 1
    for d, text, *_ in rows:
        if d is not None:
            copied = sum(len(owners[c[3]]) >= MANY_OWNERS for c in candidates(text) if c[1] < 3)
            assert got[d]["n_copied"] >= copied
    assert "token:" in got[200]["spans"] and "token:" in got[201]["spans"]
    assert got[203]["n_live"] == 0  # one owner, but not random


def test_wider_tokens_that_many_owners_hold_are_no_spans(spark):
    rows = [(i, f"see {MIXED} here", "en", f"s{i}", 0) for i in range(3)]
    assert {r["spans"] for r in secret_report(frame(spark, rows)).collect()} == {""}
    alone = secret_report(frame(spark, rows[:1])).collect()
    assert [r["spans"] for r in alone] == [f"token:4:{4 + len(MIXED)}"]


def test_empty_table_and_clean_texts(spark):
    assert secret_report(frame(spark, [])).collect() == []
    clean = secret_report(frame(spark, [(i, prose(300, i), "en", "s", 0) for i in range(5)])).collect()
    assert {r["spans"] for r in clean} == {""}
