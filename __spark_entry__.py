"""

Every route query reads the whole ``events`` table of the given scale
directory through the adapter of ``entry_tables`` (daily sessions, one-second
clock, ``event_id`` as the tie-break ``seq``).
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from entry_tables import (  # noqa: E402
    DAMAGE_BOUNDS,
    adapter_sql,
    clean_sql,
    damaged_lines,
    dirty_events,
    load_events,
    mixed_types,
    odd_pages,
    odd_sql,
    skewed_events,
    skewed_sql,
)
from trailspark import (  # noqa: E402
    all_route_counts,
    cast_events,
    cut_broadcast,
    cut_join,
    cut_partition_min,
    cut_window,
    error_events,
    first_error,
    get_routes,
    load_lines_rdd,
    page_changes,
    read_events,
    read_lines,
    read_tsv,
    register_events_view,
    route_counts,
    routes_fold,
    routes_json,
    routes_listagg,
    routes_max_array,
    routes_max_string,
    routes_pandas,
    routes_sorted,
    running_routes,
    session_routes,
    surviving_changes,
    top_pairs,
    top_routes,
    top_routes_dict,
    top_routes_rdd_df,
    top_routes_rdd_path,
    top_routes_sql,
    write_tsv,
)
from trailspark.runtime import ensure_checkpoint_dir, remove_path, scratch_path  # noqa: E402
from trailspark.schema import PREV_PAGE, ROUTE_COUNTS_SCHEMA, SEQ, event_columns  # noqa: E402
from trailspark.sources import parse_lines, write_events_tsv  # noqa: E402

try:  # the training-data operators are optional; nothing else depends on them
    import corpus_pipeline
    from trailspark.llm import queries as llm_queries
except ModuleNotFoundError as e:
    if e.name not in ("corpus_pipeline", "trailspark.llm"):
        raise  # they are there, but something that they need is not
    corpus_pipeline = llm_queries = None

SMOKE_DIR = "/root/testdata/sf0.001"
N = 10
# Coarse clock (6 h) over weekly sessions: many events share a timestamp.
COARSE = {"days": 7, "unit": 21600}
# Bucket width that cuts a session into many fragments.
MINUTE = 60

EVENT_COLS = event_columns(SEQ)


def _events(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    return load_events(spark, sf_dir, **kw)


def _skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return skewed_events(_events(spark, sf_dir))


def _cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_partition_min(_events(spark, sf_dir), SEQ)


def _changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_changes(_cut(spark, sf_dir), SEQ)


def _survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surviving_changes(_events(spark, sf_dir), SEQ)


def _hot_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surviving_changes(_skewed(spark, sf_dir), SEQ)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: top 10 routes on the smallest scale."""
    return top_routes(_events(spark, SMOKE_DIR), N, seq=SEQ)


def _from_files(spark: SparkSession, name: str, write: Callable[[str], object],
                read: Callable[[str], DataFrame]) -> DataFrame:
    """What ``read`` gives of the files that ``write`` made; the files are removed again."""
    ensure_checkpoint_dir(spark)
    path = scratch_path(spark, name)
    write(path)
    try:
        return read(path).checkpoint(eager=True)
    finally:
        remove_path(spark, path)


def _tsv(spark: SparkSession, sf_dir: str, name: str, read: Callable[[str], DataFrame],
         seq: str | None = None) -> DataFrame:
    events = _events(spark, sf_dir)
    return _from_files(spark, name, lambda p: write_events_tsv(events, p, seq), read)


def _reordered(events: DataFrame) -> DataFrame:
    """The event columns in another order, type and page swapped, and one column more."""
    return events.selectExpr(
        "event_page", "'x' AS note", "event_type", "timestamp", "seq", "session_id", "user_id")


def _typed_reordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    shuffled = _reordered(_events(spark, sf_dir))
    return _from_files(
        spark, "reordered",
        lambda p: shuffled.write.option("sep", "\t").option("header", "true").csv(p),
        lambda p: read_events(spark, p, SEQ))


def _two_headers(spark: SparkSession, sf_dir: str, name: str,
                 read: Callable[[str], DataFrame]) -> DataFrame:
    """What ``read`` gives of one folder whose files have two different headers."""
    events = _events(spark, sf_dir)
    odd = F.pmod(F.col(SEQ), F.lit(2)) == 1

    def write(path: str) -> None:
        write_events_tsv(events.filter(~odd), path, SEQ)
        (_reordered(events.filter(odd)).write.mode("append")
         .option("sep", "\t").option("header", "true").csv(path))

    return _from_files(spark, name, write, read)


def _rdd_frame(spark: SparkSession, path: str) -> DataFrame:
    """The tuples of the RDD reader, all text."""
    return spark.createDataFrame(load_lines_rdd(spark.sparkContext, path),
                                 ", ".join(f"{c} string" for c in event_columns()))


def _view_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    def read(path: str) -> DataFrame:
        register_events_view(spark, path, "typed_clicks", SEQ)
        return spark.sql(f"SELECT {', '.join(EVENT_COLS)} FROM typed_clicks")

    return _tsv(spark, sf_dir, "view", read, SEQ)


def _rdd_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tsv(spark, sf_dir, "rdd-lines", lambda p: _rdd_frame(spark, p))


def _rdd_tuples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tsv(spark, sf_dir, "rdd-tuples", lambda p: spark.createDataFrame(
        top_pairs(get_routes(load_lines_rdd(spark.sparkContext, p)), N), ROUTE_COUNTS_SCHEMA))


def _as_strings(events: DataFrame) -> DataFrame:
    return events.select(*[F.col(c).cast("string").alias(c) for c in events.columns])


def _parsed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = damaged_lines(_events(spark, sf_dir, extra=("value",)))
    return parse_lines(lines, SEQ)


def _top_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    _events(spark, sf_dir).createOrReplaceTempView("clickstream")
    return top_routes_sql(spark, "clickstream", N, seq=SEQ)


def _top_sql_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    _as_strings(_events(spark, sf_dir)).createOrReplaceTempView("raw_clicks")
    return top_routes_sql(spark, "raw_clicks", N, seq=SEQ)


def _top_rdd_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tsv(spark, sf_dir, "rdd-path", lambda p: spark.createDataFrame(
        top_routes_rdd_path(spark, p, N, SEQ), ROUTE_COUNTS_SCHEMA), SEQ)


def _top_sql_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed_types(dirty_events(_events(spark, sf_dir))).createOrReplaceTempView("mixed_clicks")
    return top_routes_sql(spark, "mixed_clicks", N, seq=SEQ)


def _routes_dict(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = all_route_counts(_events(spark, sf_dir), seq=SEQ)
    return spark.createDataFrame(list(top_routes_dict(counts, N).items()), ROUTE_COUNTS_SCHEMA)


def _routes_tsv(spark: SparkSession, events: DataFrame) -> DataFrame:
    counts = all_route_counts(events, seq=SEQ)
    return _from_files(spark, "routes-tsv", lambda p: write_tsv(counts, p),
                       lambda p: read_tsv(spark, p))


def _dirty_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    dirty_events(_events(spark, sf_dir)).createOrReplaceTempView("dirty_clicks")
    return top_routes_sql(spark, "dirty_clicks", N, seq=SEQ)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "typed_events": lambda s, d: _tsv(s, d, "typed", lambda p: read_events(s, p)),
        "typed_events_reordered": _typed_reordered,
        "typed_events_two_headers": lambda s, d: _two_headers(
            s, d, "typed-two", lambda p: read_events(s, p, SEQ)),
        "view_events": _view_events,
        "read_lines": lambda s, d: _tsv(s, d, "lines", lambda p: read_lines(s, p, SEQ), SEQ),
        "read_lines_two_headers": lambda s, d: _two_headers(
            s, d, "lines-two", lambda p: read_lines(s, p, SEQ)),
        "rdd_lines": _rdd_lines,
        "rdd_lines_two_headers": lambda s, d: _two_headers(
            s, d, "rdd-two", lambda p: _rdd_frame(s, p)),
        "cast_events": lambda s, d: cast_events(_as_strings(_events(s, d)), SEQ),
        "parsed_lines": _parsed_lines,
        "error_events": lambda s, d: error_events(_events(s, d)),
        "first_error": lambda s, d: first_error(_events(s, d)),
        "cut_window": lambda s, d: cut_window(_events(s, d), SEQ),
        "cut_window_hot": lambda s, d: cut_window(_skewed(s, d), SEQ),
        "cut_partition_min": _cut,
        "cut_partition_min_hot": lambda s, d: cut_partition_min(_skewed(s, d), SEQ),
        "cut_join": lambda s, d: cut_join(_events(s, d), SEQ),
        "cut_join_hot": lambda s, d: cut_join(_skewed(s, d), SEQ),
        "cut_broadcast": lambda s, d: cut_broadcast(_events(s, d), SEQ),
        "cut_broadcast_hot": lambda s, d: cut_broadcast(_skewed(s, d), SEQ),
        "page_changes": _changes,
        "page_changes_hot": lambda s, d: page_changes(_skewed(s, d), SEQ),
        "surviving_changes": _survivors,
        "surviving_changes_hot": _hot_survivors,
        "running_routes": lambda s, d: running_routes(_survivors(s, d), SEQ),
        "running_routes_hot": lambda s, d: running_routes(_hot_survivors(s, d), SEQ),
        "session_routes_max_array": lambda s, d: routes_max_array(_survivors(s, d), SEQ),
        "session_routes_max_array_hot": lambda s, d: routes_max_array(
            _hot_survivors(s, d), SEQ),
        "session_routes_max_string": lambda s, d: routes_max_string(_survivors(s, d), SEQ),
        "session_routes_max_string_hot": lambda s, d: routes_max_string(
            _hot_survivors(s, d), SEQ),
        "session_routes_sorted": lambda s, d: routes_sorted(_survivors(s, d), SEQ),
        "session_routes_listagg": lambda s, d: routes_listagg(_survivors(s, d), SEQ),
        "session_routes_fold": lambda s, d: routes_fold(_events(s, d), SEQ),
        "session_routes_pandas": lambda s, d: routes_pandas(_events(s, d), SEQ),
        "session_routes_hot": lambda s, d: session_routes(_skewed(s, d), seq=SEQ),
        "session_routes": lambda s, d: session_routes(_events(s, d), seq=SEQ),
        "route_counts": lambda s, d: route_counts(session_routes(_events(s, d), seq=SEQ)),
        "route_counts_coarse": lambda s, d: route_counts(
            session_routes(_events(s, d, **COARSE), seq=SEQ)),
        "route_counts_page_ties": lambda s, d: route_counts(
            session_routes(_events(s, d, **COARSE).drop(SEQ), seq=None)),
        "route_counts_hot_session": lambda s, d: route_counts(
            session_routes(_skewed(s, d), "window", SEQ)),
        "route_counts_dirty": lambda s, d: route_counts(
            session_routes(dirty_events(_events(s, d)), seq=SEQ)),
        "route_counts_dirty_join": lambda s, d: route_counts(
            session_routes(dirty_events(_events(s, d)), "join", SEQ)),
        "top_routes_dirty_sql": _dirty_sql,
        "top_routes": lambda s, d: top_routes(_events(s, d), N, seq=SEQ),
        "top_routes_window": lambda s, d: top_routes(_events(s, d), N, "window", SEQ),
        "top_routes_fold": lambda s, d: top_routes(_events(s, d), N, "fold", SEQ, MINUTE),
        "top_routes_windows": lambda s, d: top_routes(_events(s, d), N, "windows", SEQ),
        "top_routes_join": lambda s, d: top_routes(_events(s, d), N, "join", SEQ),
        "top_routes_windows_hot": lambda s, d: top_routes(_skewed(s, d), N, "windows", SEQ),
        "top_routes_join_hot": lambda s, d: top_routes(_skewed(s, d), N, "join", SEQ),
        "top_routes_broadcast": lambda s, d: top_routes(_events(s, d), N, "broadcast", SEQ),
        "top_routes_broadcast_hot": lambda s, d: top_routes(_skewed(s, d), N, "broadcast", SEQ),
        "top_routes_pandas": lambda s, d: top_routes(_events(s, d), N, "pandas", SEQ),
        "top_routes_sql": _top_sql,
        "top_routes_sql_strings": _top_sql_strings,
        "top_routes_sql_mixed": _top_sql_mixed,
        "top_routes_rdd": lambda s, d: top_routes_rdd_df(_events(s, d), N, SEQ),
        "top_routes_rdd_hot": lambda s, d: top_routes_rdd_df(_skewed(s, d), N, SEQ),
        "top_routes_rdd_path": _top_rdd_path,
        "top_routes_rdd_path_two_headers": lambda s, d: _two_headers(
            s, d, "rdd-path-two", lambda p: s.createDataFrame(
                top_routes_rdd_path(s, p, N, SEQ), ROUTE_COUNTS_SCHEMA)),
        "top_routes_rdd_tuples": _rdd_tuples,
        "routes_json": lambda s, d: routes_json(
            route_counts(session_routes(_events(s, d), seq=SEQ)), N),
        "routes_dict": _routes_dict,
        "routes_tsv": lambda s, d: _routes_tsv(s, _events(s, d)),
        "routes_tsv_odd": lambda s, d: _routes_tsv(s, odd_pages(_events(s, d))),
        **(llm_queries.queries() | {"pipeline": corpus_pipeline.run} if llm_queries else {}),
    }


# ---------------------------------------------------------------- oracle ---

_IS_ERROR = "coalesce(contains(lower(event_type), 'error'), false)"


def _pipeline(adapter: str, tie: str = SEQ) -> str:
    """CTEs c (events), s (sorted list and error time per session), k (kept list),
    p (page changes), r (routes), rc (counts): one list per session, no join, no window."""
    return f"""WITH c AS ({adapter}),
s AS (SELECT user_id, session_id, list(c ORDER BY timestamp, {tie}, event_page) AS xs,
             min(CASE WHEN {_IS_ERROR} THEN timestamp END) AS et
      FROM c GROUP BY user_id, session_id),
k AS (SELECT user_id, session_id, list_filter(xs, lambda x: et IS NULL OR x.timestamp < et) AS xs
      FROM s),
p AS (SELECT user_id, session_id, xs, list_filter(range(1, len(xs) + 1), lambda i:
             i = 1 OR xs[i].event_page <> xs[i - 1].event_page) AS ix FROM k),
r AS (SELECT user_id, session_id,
             array_to_string(list_transform(ix, lambda i: xs[i].event_page), '-') AS route
      FROM p WHERE len(xs) > 0),
rc AS (SELECT route, count(*) AS count FROM r GROUP BY route)
"""


def oracle_sql() -> dict[str, str]:
    base = _pipeline(adapter_sql())
    hot = _pipeline(skewed_sql(adapter_sql()))
    dirty = _pipeline(clean_sql(adapter_sql()))
    ev = ", ".join(EVENT_COLS)
    ev_x = ", ".join(f"x.{c} AS {c}" for c in EVENT_COLS)
    top_of = "SELECT route, count FROM rc ORDER BY count DESC, route LIMIT"
    top = f"{base}{top_of} {N}"
    routes = "SELECT user_id, session_id, route FROM r"
    counts = "SELECT route, count FROM rc"
    cut = f"SELECT {ev_x} FROM (SELECT unnest(xs) AS x FROM k) u"
    changed = (
        f"SELECT {ev_x}, prev AS {PREV_PAGE} FROM (SELECT xs[i] AS x, xs[i - 1].event_page AS prev "
        "FROM (SELECT xs, unnest(ix) AS i FROM p) a) u"
    )
    odd = _pipeline(odd_sql(adapter_sql()))
    no_seq = _pipeline(adapter_sql(), tie="event_page")
    top_hot = f"{hot}{top_of} {N}"
    hot_routes = f"{hot}SELECT user_id, session_id, route FROM r"
    all_kept = _pipeline(skewed_sql(adapter_sql())).replace("et IS NULL OR", "true OR")
    typed = f"{base}SELECT {ev} FROM c"
    texts = f"{base}SELECT " + ", ".join(
        f"CAST({c} AS VARCHAR) AS {c}" for c in event_columns()) + " FROM c"
    running = (
        "SELECT user_id, session_id, xs[i].timestamp AS timestamp, xs[i].seq AS seq, "
        "array_to_string(list_transform(list_filter(ix, lambda j: j <= i), "
        "lambda j: xs[j].event_page), '-') AS route "
        "FROM (SELECT *, unnest(ix) AS i FROM p) a"
    )
    clean = DAMAGE_BOUNDS["empty_page"]
    five = ", ".join(event_columns())
    return {
        "typed_events": f"{base}SELECT {five} FROM c",
        "typed_events_reordered": typed,
        "typed_events_two_headers": typed,
        "view_events": typed,
        "read_lines": typed,
        "read_lines_two_headers": typed,
        "rdd_lines": texts,
        "rdd_lines_two_headers": texts,
        "cast_events": typed,
        "parsed_lines": (
            f"WITH c AS ({adapter_sql(extra=('value',))}) "
            f"SELECT {ev} FROM c WHERE value IS NULL OR value >= {clean}"
        ),
        "error_events": f"{base}SELECT {ev} FROM c WHERE {_IS_ERROR}",
        "first_error": f"{base}SELECT user_id, session_id, et AS error_timestamp FROM s "
                       "WHERE et IS NOT NULL",
        "cut_window": base + cut,
        "cut_window_hot": hot + cut,
        "cut_partition_min": base + cut,
        "cut_partition_min_hot": hot + cut,
        "cut_join": base + cut,
        "cut_join_hot": hot + cut,
        "cut_broadcast": base + cut,
        "cut_broadcast_hot": hot + cut,
        "page_changes": base + changed,
        "page_changes_hot": all_kept + changed,
        "surviving_changes": base + changed,
        "surviving_changes_hot": hot + changed,
        "running_routes": base + running,
        "running_routes_hot": hot + running,
        "session_routes_max_array": base + routes,
        "session_routes_max_array_hot": hot_routes,
        "session_routes_max_string": base + routes,
        "session_routes_max_string_hot": hot_routes,
        "session_routes_sorted": base + routes,
        "session_routes_listagg": base + routes,
        "session_routes_fold": base + routes,
        "session_routes_pandas": base + routes,
        "session_routes_hot": hot + routes,
        "session_routes": base + routes,
        "route_counts": base + counts,
        "route_counts_coarse": _pipeline(adapter_sql(**COARSE)) + counts,
        "route_counts_page_ties": _pipeline(adapter_sql(**COARSE), tie="event_page") + counts,
        "route_counts_hot_session": hot + counts,
        "route_counts_dirty": dirty + counts,
        "route_counts_dirty_join": dirty + counts,
        "top_routes_dirty_sql": f"{dirty}{top_of} {N}",
        "top_routes": top,
        "top_routes_window": top,
        "top_routes_fold": top,
        "top_routes_windows": top,
        "top_routes_join": top,
        "top_routes_windows_hot": top_hot,
        "top_routes_join_hot": top_hot,
        "top_routes_broadcast": top,
        "top_routes_broadcast_hot": top_hot,
        "top_routes_pandas": top,
        "top_routes_sql": top,
        "top_routes_sql_strings": top,
        "top_routes_sql_mixed": f"{dirty}{top_of} {N}",
        "top_routes_rdd": top,
        "top_routes_rdd_hot": top_hot,
        "top_routes_rdd_path": top,
        "top_routes_rdd_path_two_headers": top,
        "top_routes_rdd_tuples": f"{no_seq}{top_of} {N}",
        "routes_json": (
            f"{base}SELECT '{{' || string_agg('\"' || route || '\":' || count, ',' "
            "ORDER BY count DESC, route) || '}' AS json "
            f"FROM ({top_of} {N}) t"
        ),
        "routes_dict": top,
        "routes_tsv": base + counts,
        "routes_tsv_odd": odd + counts,
        **(llm_queries.oracle_sql() if llm_queries else {}),
    }
