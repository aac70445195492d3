"""Properties against a brute-force model, and invariances of the result."""

from __future__ import annotations

import random
from collections import defaultdict

from conftest import SF, collect_counts, collect_routes
from entry_tables import load_events
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trailspark import FORMS, all_route_counts, session_routes
from trailspark.schema import events_schema


def brute_force(rows) -> dict[tuple[int, int], str]:
    """Routes straight from the rules: cut at the first error second, order, collapse, join."""
    sessions = defaultdict(list)
    for r in rows:
        sessions[(r[0], r[1])].append(r)
    out = {}
    for key, evs in sessions.items():
        errors = [r[4] for r in evs if r[2] is not None and "error" in r[2].lower()]
        cut = min(errors) if errors else None
        kept = sorted((r for r in evs if cut is None or r[4] < cut), key=lambda r: (r[4], r[5], r[3]))
        pages: list[str] = []
        for r in kept:
            if not pages or pages[-1] != r[3]:
                pages.append(r[3])
        if pages:
            out[key] = "-".join(pages)
    return out


event = st.tuples(
    st.integers(1, 3),
    st.integers(1, 2),
    st.sampled_from(["page", "event", "custom", "error", "xERRORx", None]),
    st.sampled_from(["A", "B", "C"]),
    st.integers(0, 6),
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(event, min_size=1, max_size=40))
def test_forms_match_brute_force(spark, raw):
    rows = [(*r, i) for i, r in enumerate(raw)]
    df = spark.createDataFrame(rows, events_schema("seq"))
    expected = brute_force(rows)
    for form, width in (("fold", 1), ("window", 3), ("pandas", 2), ("windows", 4), ("join", 2)):
        assert collect_routes(session_routes(df, form, "seq", width)) == expected, (form, width)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(event, min_size=1, max_size=40))
def test_repeated_tiebreak_values_still_give_one_answer(spark, raw):
    # seq repeats (i // 3): rows equal on (timestamp, seq) are ordered by page.
    rows = [(*r, i // 3) for i, r in enumerate(raw)]
    df = spark.createDataFrame(rows, events_schema("seq"))
    expected = brute_force(rows)
    for form, width in (("window", 1), ("fold", 2), ("pandas", 3), ("windows", 9), ("join", 3)):
        assert collect_routes(session_routes(df, form, "seq", width)) == expected, (form, width)


def _events(spark):
    return load_events(spark, SF["sf0.001"], days=7, unit=21600)


def test_permutation_and_repartition_change_nothing(spark):
    events = _events(spark)
    reference = collect_counts(all_route_counts(events, seq="seq"))
    rows = events.collect()
    random.Random(7).shuffle(rows)
    shuffled = spark.createDataFrame(rows, events.schema).repartition(5)
    for form in FORMS:
        assert collect_counts(all_route_counts(shuffled, form, "seq")) == reference, form


def test_rows_at_or_after_the_error_change_nothing(spark):
    events = _events(spark)
    reference = collect_routes(session_routes(events, seq="seq"))
    errors = events.filter(F.lower("event_type").contains("error"))
    noise = errors.select(
        "user_id", "session_id", F.lit("page").alias("event_type"), F.lit("ZZ").alias("event_page"),
        "timestamp", (F.col("seq") + 10_000_000).alias("seq"),
    )
    later = noise.withColumn("timestamp", F.col("timestamp") + 1)
    grown = events.unionByName(noise).unionByName(later)
    for form in ("fold", "window", "join"):
        assert collect_routes(session_routes(grown, form, "seq")) == reference, form


def test_duplicate_rows_change_nothing(spark):
    events = _events(spark)
    reference = collect_routes(session_routes(events, seq="seq"))
    doubled = events.unionByName(events)
    for form in FORMS:
        assert collect_routes(session_routes(doubled, form, "seq", 3600)) == reference, form


def test_counts_sum_to_sessions_with_a_surviving_event(spark):
    events = _events(spark)
    counts = collect_counts(all_route_counts(events, seq="seq"))
    rows = [tuple(r) for r in events.collect()]
    assert sum(counts.values()) == len(brute_force(rows))
