"""Which values are widely held: by owners and repositories, equal texts counted once."""

from __future__ import annotations

from cases import frame, prose

from trailspark.llm.secret_scan import WIDE_OWNERS, WIDE_REPOS, secret_report

MIXED = "aB3dE5fG7hJ9kL1mN3pQ5rS7tU9vW1xY3"
KEY = "AKIA" + "Q7ZP2M5K" * 2
SPAN = f"token:0:{len(MIXED)}"


def report(spark, rows):
    return secret_report(frame(spark, rows, clash=True), widely=True).collect()


def test_copies_of_one_document_leave_its_values_live(spark):
    text = f"{MIXED} and {KEY}"
    for r in report(spark, [(i, text, "en", f"s{i}", 0) for i in range(40)]):
        assert SPAN in r["spans"] and "access:" in r["spans"]
        assert (r["n_live"], r["n_copied"]) == (2, 0)
        assert r["owners"] == r["repos"] == [1, 1]


def test_both_counts_decide_and_copied_tokens_stay_visible(spark):
    def got(owners, repos):
        rows = [(i, f"{MIXED} {prose(9, i)}", "en", f"s{i % owners}", 0) for i in range(repos)]
        found = report(spark, rows)
        assert all(r["spans"] == SPAN for r in found)
        assert all((r["owners"], r["repos"]) == ([owners], [repos]) for r in found)
        return {(r["n_live"], r["n_copied"]) for r in found}

    assert got(WIDE_OWNERS, WIDE_REPOS) == {(0, 1)}
    assert got(WIDE_OWNERS - 1, WIDE_REPOS) == {(1, 0)}
    assert got(WIDE_OWNERS, WIDE_REPOS - 1) == {(1, 0)}


def test_near_copies_count_once(spark):
    body = prose(400, 5)
    rows = [(i, f"{body} {KEY} edit{i}", "en", f"s{i}", 0) for i in range(30)]
    got = report(spark, rows)
    assert max(max(r["owners"]) for r in got) < WIDE_OWNERS
    assert {tuple(r["classes"]) for r in got} == {("live",)}


def brute(rows):
    """Classes per row: holders folded by fingerprints at most two bits apart, closed over links."""
    from collections import defaultdict

    from trailspark.llm.secret_scan import MIN_ENTROPY, candidates, entropy
    from trailspark.llm.simhash import fingerprint

    hits = [(i, r) for i, r in enumerate(rows) if candidates(r[1])]
    prints = {i: fingerprint(r[1]) for i, r in hits}
    root = {fp: fp for fp in prints.values()}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in root:
        for b in root:
            if bin((a ^ b) & ((1 << 64) - 1)).count("1") <= 2:
                root[find(a)] = find(b)
    holders = defaultdict(dict)
    for i, (d, text, _, source, _) in hits:
        mine = ("?" if source is None else f"={source}", "?" if d is None else f"={d}")
        for *_, value in candidates(text):
            key = find(prints[i])
            holders[value][key] = min(holders[value].get(key, mine), mine)
    out = []
    for d, text, *_ in rows:
        classes = []
        for _, kind, _, value in candidates(text):
            owners, repos = ({h[k] for h in holders[value].values()} for k in (0, 1))
            pairs = set(holders[value].values())
            wide = len(owners) >= WIDE_OWNERS and len(pairs) >= WIDE_REPOS
            looks = entropy(value) >= MIN_ENTROPY
            if kind < 3 or looks:
                classes.append("copied" if wide else "live" if looks else "plain")
        out.append((d, tuple(classes)))
    return sorted(out, key=repr)


def test_classes_against_brute_force(spark):
    rows = [(i, f"{prose(30, i)} {KEY} {prose(5, 50 + i)}", "en", f"s{i % 5}", 0) for i in range(12)]
    rows += [(100 + i, f"{prose(40, 7)} {MIXED} x{i}", "en", f"s{i}", 0) for i in range(9)]
    rows += [(200 + i, f"password=aaaaaaaaaa {prose(8 + i, 300 + i)}", "en", f"s{i}", 0) for i in range(3)]
    rows += [(300, f"secret='{MIXED}z' 0123456789abcdef01234567", None, None, 0), (None, KEY, "en", "q", 0),
             (301, None, "en", "s", 0), (302, "clean", "en", "s", 0)]
    got = report(spark, rows)
    assert sorted(((r["doc_id"], tuple(r["classes"])) for r in got), key=repr) == brute(rows)
    assert {c for _, cs in brute(rows) for c in cs} == {"copied", "live", "plain"}
    for r in got:
        assert (r["n_copied"], r["n_live"], r["n_plain"]) == tuple(
            r["classes"].count(c) for c in ("copied", "live", "plain"))


def test_a_value_without_randomness_is_no_copied_example(spark):
    [r] = report(spark, [(1, "password=aaaaaaaaaa", "en", "s", 0)])
    assert (r["n_copied"], r["n_live"], r["n_plain"]) == (0, 0, 1)


def test_long_text_dense_with_matches(spark):
    import time

    from trailspark.llm.secret_scan import candidates

    text = " ".join(f"token={MIXED}{i} {MIXED}{i}x" for i in range(20_000))
    began = time.time()
    found = candidates(text)
    assert len(found) == 40_000 and time.time() - began < 20
    [r] = report(spark, [(1, text, "en", "s", 0)])
    assert (r["n_assign"], len(r["classes"])) == (20_000, 40_000)
