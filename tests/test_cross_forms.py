"""Every form gives the same full route-count table on the real test tables."""

from __future__ import annotations

import pytest
from conftest import SF, collect_counts
from entry_tables import load_events

from trailspark import FORMS, all_route_counts, top_routes, top_routes_rdd, top_routes_sql

VARIANTS = {
    "daily": {"days": 1, "unit": 1},
    "coarse": {"days": 7, "unit": 21600},
}

# Published sizes (routed sessions, distinct routes) of the adapter variants.
EXPECTED = {
    ("sf0.001", "daily"): (319, 61),
    ("sf0.01", "daily"): (3185, 160),
    ("sf0.01", "coarse"): (555, 256),
}


@pytest.mark.parametrize("sf,variant", list(EXPECTED))
def test_forms_agree(spark, sf, variant):
    events = load_events(spark, SF[sf], **VARIANTS[variant]).cache()
    reference = collect_counts(all_route_counts(events, "fold", "seq", 10**9))
    assert (sum(reference.values()), len(reference)) == EXPECTED[(sf, variant)]
    for form in FORMS:
        for width in (60, 86400):
            got = collect_counts(all_route_counts(events, form, "seq", width))
            assert got == reference, (form, width)
    events.unpersist()


def test_top3_daily_sf001(spark):
    events = load_events(spark, SF["sf0.01"])
    top = [tuple(r) for r in top_routes(events, 3, seq="seq").collect()]
    assert top == [("p3", 429), ("p1", 408), ("p2", 382)]
    assert top_routes_rdd(events, 3, "seq") == top
    events.createOrReplaceTempView("cross_clicks")
    assert [tuple(r) for r in top_routes_sql(spark, "cross_clicks", 3, seq="seq").collect()] == top


def test_page_tiebreak_without_seq_agrees(spark):
    events = load_events(spark, SF["sf0.01"], **VARIANTS["coarse"]).drop("seq")
    reference = collect_counts(all_route_counts(events, "fold", None, 10**9))
    for form in FORMS:
        assert collect_counts(all_route_counts(events, form, None, 3600)) == reference, form


def test_broadcast_cut_leaves_the_choice_to_aqe_unless_told(spark):
    import contextlib
    import io

    from trailspark import cut_broadcast, cut_join

    events = load_events(spark, SF["sf0.01"])
    expected = sorted(map(tuple, cut_join(events, "seq").collect()))
    auto = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in auto}
    try:
        for k in auto:
            spark.conf.set(k, "-1")
        for hint, join in ((False, "SortMergeJoin"), (True, "BroadcastHashJoin")):
            cut = cut_broadcast(events, "seq", hint=hint)
            buf = io.StringIO()
            with contextlib.redirect_stdout(buf):
                cut.explain()
            assert join in buf.getvalue(), hint
            assert sorted(map(tuple, cut.collect())) == expected
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_sql_types_each_column_by_its_own(spark):
    from entry_tables import mixed_types

    events = load_events(spark, SF["sf0.001"])
    expected = [tuple(r) for r in top_routes(events, 30, seq="seq").collect()]
    mixed_types(events).createOrReplaceTempView("mixed_types_clicks")
    events.selectExpr("cast(user_id as int) AS user_id", "cast(session_id as string) AS session_id",
                      "event_type", "event_page", "cast(timestamp as decimal(20,0)) AS timestamp",
                      "cast(seq as double) AS seq").createOrReplaceTempView("other_types_clicks")
    bad = events.withColumn("user_id", events["user_id"].cast("string")).selectExpr(
        "' 5' AS user_id", "session_id", "event_type", "event_page", "timestamp", "seq")
    mixed_types(events).unionByName(bad).createOrReplaceTempView("rejects_clicks")
    for view in ("mixed_types_clicks", "other_types_clicks", "rejects_clicks"):
        assert [tuple(r) for r in top_routes_sql(spark, view, 30, seq="seq").collect()] == expected, view
