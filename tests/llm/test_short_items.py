"""Test items under MIN_CHARS characters match verbatim, between word boundaries."""

from __future__ import annotations

from cases import frame

from trailspark.llm.decontaminate import decontaminate, find_leaks

ITEMS = [(1, "Who  wrote Hamlet?"), (2, "2 + 2"), (3, None), (4, " \n"), (5, "art")]
DOCS = [
    (10, "Quiz: who wrote\nHAMLET? Nobody knows.", "en", "s", 0), (11, "who wrote hamlets?", "en", "s", 0),
    (12, "Is 12 + 2 = 14, or is 2 + 22 more?", "en", "s", 0), (13, "12 + 2, then 2 + 2", "en", "s", 0),
    (14, "a party, a start", "en", "s", 0), (15, "the art", "en", "s", 0), (16, None, "en", "s", 0),
]


def test_short_items_match_whole_words_only(spark):
    docs, items = frame(spark, DOCS, clash=True), frame(spark, ITEMS, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"], r["distance"], r["budget"], r["start"], r["end"])
           for r in find_leaks(docs, items).collect()}
    assert got == {(10, 1, 0, 0, 6, 23), (13, 2, 0, 0, 13, 18), (15, 5, 0, 0, 4, 7)}
    assert {r["doc_id"] for r in decontaminate(docs, items).collect()} == {11, 12, 14, 16}
