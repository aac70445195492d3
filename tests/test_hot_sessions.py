"""One long session: spread over tasks in every form, read once, linear, merged from states."""

from __future__ import annotations

import random
import statistics

import pytest
from conftest import SF, collect_routes
from entry_tables import load_events, skewed_events
from pyspark.sql import functions as F

from trailspark import (
    cut_join,
    cut_partition_min,
    cut_window,
    get_routes,
    page_changes,
    routes_max_array,
    routes_max_string,
    routes_sorted,
    running_routes,
    session_routes,
    surviving_changes,
    top_pairs,
    top_routes,
)
from trailspark.operators.buckets import with_bucket
from trailspark.operators.cut import cut_broadcast, cut_rows
from trailspark.operators.paths import BLOCK, running_in_block, with_block
from trailspark.plans.rdd import (
    bucket_state,
    fold_bucket,
    fold_session,
    fold_sorted,
    fragment,
    fragments_route,
    merge_states,
    route_pairs_rdd,
    state_route,
)
from trailspark.schema import events_schema

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def shuffled_joins(spark):
    """No broadcast, no merged partitions: what lies where shows."""
    old = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _executed(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def _balance(df) -> float:
    """Rows of the largest partition, of the median one."""
    counts = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    return max(counts) / statistics.median(counts)


def test_joined_rows_of_a_long_session_are_spread(spark, shuffled_joins):
    hot = skewed_events(load_events(spark, SF["sf0.01"]))
    share = hot.filter("user_id = 0").count() / hot.count()
    assert share > 0.15  # by session, one of 16 partitions would hold 3 times the median
    assert _balance(cut_rows(with_bucket(hot, 600))) < 1.7


@pytest.mark.parametrize("form", ["join", "broadcast"])
def test_join_and_window_share_the_exchange_by_bucket(spark, shuffled_joins, form):
    plan = _executed(session_routes(load_events(spark, SF["sf0.001"]), form, "seq"))
    below = plan[plan.index("Window [lag"):]
    to_join = below[:below.index("SortMergeJoin")]
    assert "Exchange" not in to_join
    exchanges = below.split("Exchange hashpartitioning(")[1:]
    assert len(exchanges) == 4  # the rows; of the table: its aggregate, its window, its join
    assert "__trail_bucket" in exchanges[0].split(")")[0]


def test_collapse_and_cut_read_their_input_once(spark, shuffled_joins):
    events = load_events(spark, SF["sf0.001"])
    for df, scans in ((page_changes(events, "seq"), 1), (surviving_changes(events, "seq"), 2),
                      (page_changes(cut_partition_min(events, "seq"), "seq"), 2),
                      (routes_sorted(surviving_changes(events, "seq"), "seq"), 2),
                      (running_routes(surviving_changes(events, "seq"), "seq"), 2)):
        plan = _executed(df)
        assert plan.count("FileScan parquet") == scans, df.columns
        assert "ReusedExchange" in plan


def test_fused_cut_and_collapse_equal_the_two_operators(spark):
    hot = skewed_events(load_events(spark, SF["sf0.001"]))
    expected = sorted(map(tuple, page_changes(cut_window(hot, "seq"), "seq").collect()))
    for width in (60, 3600, 10**9):
        assert sorted(map(tuple, surviving_changes(hot, "seq", width).collect())) == expected


def test_rows_with_null_ids_do_not_depend_on_the_width(spark):
    rows = [(None, 1, "page", "A", 1, 1), (None, 1, "page", "A", 5000, 2), (None, 1, "error", "B", 9000, 3),
            (None, 1, "page", "C", 20000, 4), (1, None, "page", "C", 1, 5), (1, None, "page", "C", 9000, 6),
            (1, 1, "page", "A", 1, 7), (1, 1, "page", "A", 9000, 8), (1, 1, "page", None, 9001, 9),
            (1, 1, "page", "B", None, 10)]
    df = spark.createDataFrame(rows, events_schema("seq"))
    kept = {1, 2, 5, 6, 7, 8, 9, 10}
    for width in (10, 10**9):
        for cut in (cut_window, cut_partition_min):
            assert {r["seq"] for r in cut(df, "seq", width).collect()} == kept
        assert {r["seq"] for r in page_changes(df, "seq", width).collect()} == {1, 3, 4, 5, 7, 10}
        # An equality join has no partner for a null.
        assert {r["seq"] for r in cut_join(df, "seq", width).collect()} == kept | {3, 4}
    assert {r["seq"] for r in cut_broadcast(df, "seq").collect()} == kept | {3, 4}


def _one_session(n: int, pages: int = 3, seed: int = 1):
    rng = random.Random(seed)
    return [(1, 1, "page", f"p{rng.randrange(pages)}", i // 2, i) for i in range(n)]


def test_running_routes_scan_over_buckets(spark):
    rows = _one_session(400) + [(2, 1, "page", "x", 7, 1)]
    changes = page_changes(spark.createDataFrame(rows, events_schema("seq")), "seq")
    expected, last = {}, None
    for _, _, _, page, ts, seq in rows[:-1]:
        if page != last:
            expected[ts, seq] = (expected[max(expected)] + "-" if expected else "") + page
            last = page
    for width in (1, 7, 10**6):
        got = running_routes(changes, "seq", width)
        assert got.columns == ["user_id", "session_id", "timestamp", "seq", "route"]
        found = {(r["timestamp"], r["seq"]): r["route"] for r in got.filter("user_id = 1").collect()}
        assert found == expected
        assert [r["route"] for r in got.filter("user_id = 2").collect()] == ["x"]


def test_running_lists_are_as_long_as_a_block(spark):
    rows = _one_session(8000, 4)
    df = with_bucket(spark.createDataFrame(rows, events_schema("seq")), 10**9)
    size = F.size(running_in_block(F.col("event_page"), "seq"))
    [row] = with_block(df, "seq").select(size.alias("n")).agg(F.max("n"), F.sum("n")).collect()
    assert row[0] == BLOCK and row[1] <= len(rows) * BLOCK
    changes = page_changes(spark.createDataFrame(rows, events_schema("seq")), "seq")
    expected = collect_routes(routes_sorted(changes, "seq", 10**9))
    assert len(expected[1, 1].split("-")) > 5000
    for route in (routes_max_array, routes_max_string):
        assert collect_routes(route(changes, "seq", 10**9)) == expected
    events = spark.createDataFrame(rows, events_schema("seq"))
    assert collect_routes(session_routes(events, "windows", "seq", 10**9)) == expected


def test_states_merge_in_any_order():
    rng = random.Random(3)
    for _ in range(300):
        events = [(rng.randrange(40), i, rng.choice("ABC"), rng.random() < 0.04) for i in range(rng.randrange(1, 50))]
        buckets: dict[int, list] = {}
        for e in events:
            buckets.setdefault(e[0] - e[0] % 5, []).append(e)
        states = [bucket_state(b, *fold_bucket(es)) for b, es in buckets.items()]
        rng.shuffle(states)
        while len(states) > 1:
            a = states.pop(rng.randrange(len(states)))
            states.append(merge_states(a, states.pop(rng.randrange(len(states)))))
        assert state_route(states[0]) == fold_session(events)
        # Nothing behind the first error is carried along.
        stop, parts = states[0]
        assert stop is None or all(k <= stop for k in parts)


def test_routes_of_an_rdd_of_tuples(spark):
    events = load_events(spark, SF["sf0.001"]).drop("seq")
    tuples = events.rdd.map(lambda r: tuple(str(v) for v in r))
    assert top_pairs(get_routes(tuples), 20) == [
        tuple(r) for r in top_routes(events, 20).collect()]
    bad = [("1", "1", "page", "A", "1"), ("01", "+1", None, "A", "2"), ("1", "1", "page", "B", "x"),
           ("1", "", "page", "B", "3"), ("1", "1", "page", "", "4"), ("1", "1", "page", "C", "5"),
           ("9223372036854775808", "1", "page", "A", "1"), ("1", "1", "page", "B", "5\n"),
           ("1", "1", "xERROR", "D", "6"), ("1", "1", "page", "D", "7")]
    assert get_routes(spark.sparkContext.parallelize(bad, 3), width=2).collect() == [("A-C", 1)]


def test_fragments_of_a_session_join_in_order():
    rng = random.Random(5)
    for _ in range(300):
        events = [(rng.randrange(40), rng.choice("ABC"), "", rng.random() < 0.04) for i in range(rng.randrange(1, 50))]
        events = [(t, p, p, e) for t, p, _, e in events]
        buckets: dict[int, list] = {}
        for e in events:
            buckets.setdefault(e[0] - e[0] % 5, []).append(e)
        for es in buckets.values():
            assert (fold_sorted(sorted(es))[0], tuple(fold_sorted(sorted(es))[1])) == fold_bucket(es)
        parts = (fragment(*fold_sorted(sorted(buckets[b]))) for b in sorted(buckets))
        route, n = fragments_route(parts)
        assert route == fold_session(events) and n == (len(route.split("-")) if route else 0)


def test_rdd_forms_hold_no_table_of_sessions(spark):
    rows = [(str(i % 7), "1", "page", f"p{i % 3}", str(i)) for i in range(50)]
    pairs = get_routes(spark.sparkContext.parallelize(rows, 2))
    # Sorted runs, which are read one by one, instead of tables in the workers' memory.
    lineage = pairs.toDebugString().decode()
    assert lineage.count("ShuffledRDD") == 2 and pairs.getNumPartitions() >= 4 * 2
    events = spark.createDataFrame([(int(u), int(s), k, p, int(t)) for u, s, k, p, t in rows], events_schema())
    framed = route_pairs_rdd(events)
    assert sorted(framed.collect()) == sorted(pairs.collect())


def test_running_routes_move_what_is_linear(spark, shuffled_joins):
    rows = [(1, 1, "page", f"p{i % 3}", i * 3600, i) for i in range(3000)]
    changes = page_changes(spark.createDataFrame(rows, events_schema("seq")), "seq")
    df = running_routes(changes, "seq")
    # No running list over a session's buckets or rows; copies of its route are few.
    assert "collect_list" not in "".join(
        line for line in _executed(df).splitlines() if "windowspecdefinition" in line)
    assert df.agg(F.sum(F.length("route"))).first()[0] == sum(3 * i - 1 for i in range(1, 3001))
