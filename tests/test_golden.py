"""Golden fixtures: the task's worked example and the edge sessions, through every form."""

from __future__ import annotations

import pytest
from conftest import collect_counts, collect_routes
from fixtures import (
    EDGE,
    EDGE_COUNTS_SEQ,
    EDGE_ROUTES_PAGE,
    EDGE_ROUTES_SEQ,
    WORKED,
    WORKED_ROUTES,
    tsv,
    write,
)

from trailspark import (
    FORMS,
    all_route_counts,
    read_events,
    register_events_view,
    session_routes,
    top_routes,
    top_routes_rdd,
    top_routes_sql,
)

# Bucket widths: two seconds (many fragments) and whole sessions.
WIDTHS = [2, 10**9]


@pytest.fixture(scope="module")
def worked(spark, tmp_path_factory):
    path = write(tmp_path_factory.mktemp("worked"), "worked.tsv", tsv(WORKED))
    return read_events(spark, path)


@pytest.fixture(scope="module")
def edge_seq(spark, tmp_path_factory):
    path = write(tmp_path_factory.mktemp("edge"), "edge.tsv", tsv(EDGE, with_seq=True))
    return read_events(spark, path, seq="seq")


@pytest.fixture(scope="module")
def edge_page(spark, tmp_path_factory):
    path = write(tmp_path_factory.mktemp("edge_page"), "edge.tsv", tsv(EDGE))
    return read_events(spark, path)


@pytest.mark.parametrize("form", list(FORMS))
@pytest.mark.parametrize("width", WIDTHS)
def test_worked_example(worked, form, width):
    assert collect_routes(session_routes(worked, form, None, width)) == WORKED_ROUTES


@pytest.mark.parametrize("form", list(FORMS))
@pytest.mark.parametrize("width", WIDTHS)
def test_edge_sessions_with_seq(edge_seq, form, width):
    assert collect_routes(session_routes(edge_seq, form, "seq", width)) == EDGE_ROUTES_SEQ


@pytest.mark.parametrize("form", list(FORMS))
@pytest.mark.parametrize("width", WIDTHS)
def test_edge_sessions_page_tiebreak(edge_page, form, width):
    assert collect_routes(session_routes(edge_page, form, None, width)) == EDGE_ROUTES_PAGE


def test_edge_counts_and_topn(edge_seq):
    assert collect_counts(all_route_counts(edge_seq, seq="seq")) == EDGE_COUNTS_SEQ
    top2 = [tuple(r) for r in top_routes(edge_seq, 2, seq="seq").collect()]
    assert top2 == [("A-B", 3), ("A", 2)]
    top4 = [tuple(r) for r in top_routes(edge_seq, 4, seq="seq").collect()]
    assert top4 == [("A-B", 3), ("A", 2), ("A-B-A-C", 1), ("A-B-C", 1)]


@pytest.mark.parametrize("width", WIDTHS)
def test_sql_form(spark, edge_seq, width):
    edge_seq.createOrReplaceTempView("edge_clicks")
    rows = [tuple(r) for r in top_routes_sql(spark, "edge_clicks", 4, seq="seq", width=width).collect()]
    assert rows == [("A-B", 3), ("A", 2), ("A-B-A-C", 1), ("A-B-C", 1)]


def test_sql_over_registered_file_view(spark, tmp_path):
    path = write(tmp_path, "worked.tsv", tsv(WORKED))
    register_events_view(spark, path, "clickstream")
    rows = {r["route"]: r["count"] for r in top_routes_sql(spark, "clickstream", 10).collect()}
    assert rows == {"main-family-main": 1, "main-archive-bonus-tariffs": 1}


@pytest.mark.parametrize("width", WIDTHS)
def test_rdd_form(edge_seq, width):
    assert top_routes_rdd(edge_seq, 4, "seq", width) == [("A-B", 3), ("A", 2), ("A-B-A-C", 1), ("A-B-C", 1)]


def test_sql_over_untyped_string_view(spark, tmp_path):
    # As the task's SQL path: a header-only read leaves every column a string.
    path = write(tmp_path, "edge.tsv", tsv(EDGE, with_seq=True))
    spark.read.csv(path, header=True, sep="\t").createOrReplaceTempView("raw_clicks")
    rows = [tuple(r) for r in top_routes_sql(spark, "raw_clicks", 4, seq="seq").collect()]
    assert rows == [("A-B", 3), ("A", 2), ("A-B-A-C", 1), ("A-B-C", 1)]


def test_cast_events_and_rdd_path(spark, tmp_path):
    from trailspark import cast_events
    from trailspark.plans import top_routes_rdd_path

    path = write(tmp_path, "worked.tsv", tsv(WORKED))
    typed = cast_events(spark.read.csv(path, header=True, sep="\t"))
    assert dict(typed.dtypes)["timestamp"] == "bigint"
    assert collect_routes(session_routes(typed)) == WORKED_ROUTES
    assert sorted(top_routes_rdd_path(spark, path, 10)) == sorted(
        (r, 1) for r in WORKED_ROUTES.values())


def test_empty_input_everywhere(spark):
    from trailspark import routes_json
    from trailspark.schema import events_schema

    empty = spark.createDataFrame([], events_schema("seq"))
    for form in FORMS:
        assert session_routes(empty, form, "seq").collect() == [], form
    empty.createOrReplaceTempView("empty_clicks")
    assert top_routes_sql(spark, "empty_clicks", 10, seq="seq").collect() == []
    assert top_routes_rdd(empty, 10, "seq") == []
    assert [r["json"] for r in routes_json(all_route_counts(empty, seq="seq")).collect()] == ["{}"]
