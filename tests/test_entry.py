"""Driver contract and plan shapes."""

from __future__ import annotations

import contextlib
import io

import __spark_entry__ as entry
from conftest import SF
from entry_tables import load_events

from trailspark import FORMS, session_routes, top_routes, top_routes_sql


def _plan(df, mode="formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 10
    assert df.columns == ["route", "count"]


def test_every_route_query_has_an_oracle():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    own = {x for x in q if not x.startswith("op") and x != "pipeline"}
    assert own <= set(o)


def test_flagship_plan_prunes_and_reads_once(spark):
    plan = _plan(top_routes(load_events(spark, SF["sf0.01"]), 10, seq="seq"))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "TakeOrderedAndProject" in plan
    # The value column of events is never read.
    for line in plan.splitlines():
        if line.strip().startswith("ReadSchema"):
            assert "value" not in line
    assert plan.count("ReadSchema") == 1
    # Events by bucket, fragments by session, routes: three exchanges, no join.
    assert "BroadcastExchange" not in plan and "rangepartitioning" not in plan


def test_building_a_plan_runs_no_job(spark):
    sc = spark.sparkContext
    events = load_events(spark, SF["sf0.01"])
    events.createOrReplaceTempView("plan_clicks")
    sc.setJobGroup("plans-only", "plans-only")
    try:
        for form in FORMS:
            session_routes(events, form, "seq")
        top_routes_sql(spark, "plan_clicks", 10, seq="seq")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert list(sc.statusTracker().getJobIdsForGroup("plans-only")) == []
