"""Session routes: one ``user_id, session_id, route`` row per session with a surviving event.

Building blocks over page-change rows (already cut and collapsed):

* ``running_routes`` — running list of pages per row (W3), as a prefix of the
  session's text. Its output is quadratic in the session length by definition;
  what it moves is linear, and nothing else here uses it.
* ``routes_max_array`` / ``routes_max_string`` — the reference's window forms:
  the longest running list / string is the route (A2, A3). The running lists
  exist per block of ``BLOCK`` changes of a bucket, so they are linear in its
  changes.
* ``routes_sorted`` — collect ``(order, page)`` structs, ``array_sort``, take
  the pages (A4, K5, X2-X4).
* ``routes_listagg`` — the same with an ordered string aggregate.

Whole-pipeline forms over raw events:

* ``routes_fold`` — one aggregate per bucket (error time and the set of
  events), then array functions only: sort, cut, collapse, join.
* ``routes_window`` — window-min cut and ``lag`` in one window pass per bucket.

All work per time bucket and put a session's fragments together (see
``buckets``), so no session's events are held by one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions import collapse_repeats, join_route
from ..schema import BUCKET_SECONDS, KEY, PAGE, ROUTE, SEPARATOR, SESSION, TS, USER, order_columns
from .buckets import (
    BUCKET,
    BUCKET_KEY,
    CUT,
    PAGES,
    distinct_events,
    earlier_buckets,
    error_time,
    event_entry,
    kept_pages,
    slim_events,
    stitch,
    with_bucket,
)

_XS, _BEFORE, _END = "__trail_xs", "__trail_before", "__trail_end"
_ROWS, _LENGTH, _RUN = "__trail_rows", "__trail_length", "__trail_run"
BLOCK_NUMBER = "__trail_block"

# Rows of a bucket that share their running lists, which are quadratic in this.
BLOCK = 64

# Rows of a session that share a copy of its route, at least, and such copies at most.
RUN_ROWS = 4096
RUNS = 64


def _ordered(key: tuple[str, ...], seq: str | None) -> WindowSpec:
    return Window.partitionBy(*key).orderBy(*order_columns(seq))


def _uncut(fragments: DataFrame) -> DataFrame:
    return fragments.withColumn(CUT, F.lit(None).cast("bigint"))


def _joined(pieces: DataFrame, *place: str) -> DataFrame:
    """Routes from pieces of one, joined in the order of the columns ``place``."""
    parts = F.array_sort(F.collect_list(F.struct(*place, ROUTE)))
    return pieces.groupBy(*KEY).agg(parts.alias(_XS)).select(
        *KEY, F.concat_ws(SEPARATOR, F.transform(_XS, lambda x: x[ROUTE])).alias(ROUTE))


def with_block(rows: DataFrame, seq: str | None) -> DataFrame:
    """The number of each row's block of ``BLOCK`` rows in its bucket."""
    number = F.row_number().over(_ordered(BUCKET_KEY, seq))
    return rows.withColumn(BLOCK_NUMBER, F.floor((number - 1) / BLOCK))


def running_in_block(page: Column, seq: str | None) -> Column:
    """Running list of ``page`` (nulls left out) over the block up to each row."""
    w = _ordered((*BUCKET_KEY, BLOCK_NUMBER), seq).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return F.collect_list(page).over(w)


def blocks_joined(blocks: DataFrame, *also: Column) -> DataFrame:
    """``PAGES`` per bucket from one list per block, and the aggregates ``also``."""
    parts = F.array_sort(F.collect_list(F.struct(BLOCK_NUMBER, PAGES)))
    lists = F.transform(_XS, lambda x: x[PAGES])
    return (blocks.groupBy(*BUCKET_KEY).agg(parts.alias(_XS), *also)
            .withColumn(PAGES, F.flatten(lists)).drop(_XS))


def _matched(left: DataFrame, right: DataFrame, *on: str) -> DataFrame:
    """Inner join where null keys are equal, as in windows and groups; ``on`` once."""
    other = right.select(*[F.col(c).alias(f"{c}_r" if c in on else c) for c in right.columns])
    same = [left[c].eqNullSafe(other[f"{c}_r"]) for c in on]
    return left.join(other, same).drop(*[f"{c}_r" for c in on])


def running_routes(changes: DataFrame, seq: str | None = None,
                   width: int = BUCKET_SECONDS) -> DataFrame:
    """Route so far at every page change: ``user_id, session_id, timestamp[, seq], route``.

    A row's route is a prefix of its session's, so rows carry a length until the
    last join: the characters of their bucket up to them, and of the earlier
    buckets. A session's buckets are dealt into ``RUNS`` runs at most, each of
    which gets the session's text up to its end once; so what is moved is linear
    in the changes, and a session is spread over tasks. The routes themselves
    stay quadratic, as every row carries its own; they are only written.
    """
    running = _ordered(BUCKET_KEY, seq).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    keep = dict.fromkeys([*KEY, *order_columns(seq), PAGE])
    # Characters with the separator behind each page.
    length = F.coalesce(F.length(PAGE) + F.length(F.lit(SEPARATOR)), F.lit(0)).cast("bigint")
    rows = with_bucket(changes, width).select(*keep, BUCKET).withColumn(
        _END, F.sum(length).over(running))
    session = Window.partitionBy(*KEY)
    spans = (
        rows.groupBy(*BUCKET_KEY).agg(F.count(F.lit(1)).alias(_ROWS), F.max(_END).alias(_LENGTH))
        .select(
            *BUCKET_KEY, _LENGTH,
            F.coalesce(F.sum(_LENGTH).over(earlier_buckets()), F.lit(0)).alias(_BEFORE),
            F.floor(F.coalesce(F.sum(_ROWS).over(earlier_buckets()), F.lit(0)) / F.greatest(
                F.lit(RUN_ROWS), F.ceil(F.sum(_ROWS).over(session) / RUNS))).alias(_RUN))
    )
    page = F.when(F.col(PAGE).isNotNull(), F.struct(_END, PAGE))
    texts = rows.groupBy(*BUCKET_KEY).agg(F.array_sort(F.collect_list(page)).alias(_XS)).filter(
        F.size(_XS) > 0).select(*BUCKET_KEY, join_route(F.transform(_XS, lambda x: x[PAGE])).alias(ROUTE))
    ends = spans.groupBy(*KEY, _RUN).agg(F.max(F.col(_BEFORE) + F.col(_LENGTH)).alias(_END))
    upto = _matched(ends, _joined(texts, BUCKET), *KEY).select(
        *KEY, _RUN, _prefix(F.col(_END)).alias(ROUTE))
    out = [USER, SESSION, TS] + ([seq] if seq else [])
    placed = _matched(rows, spans, *BUCKET_KEY).select(
        *out, _RUN, (F.col(_BEFORE) + F.col(_END)).alias(_END))
    return _matched(placed, upto, *KEY, _RUN).select(*out, _prefix(F.col(_END)).alias(ROUTE))


def _prefix(end: Column) -> Column:
    """The route up to ``end`` characters, without the separator behind its last page."""
    return F.col(ROUTE).substr(F.lit(1), (end - F.length(F.lit(SEPARATOR))).cast("int"))


def routes_max_array(changes: DataFrame, seq: str | None = None,
                     width: int = BUCKET_SECONDS) -> DataFrame:
    """Longest running page list (A2): running lists are prefixes of the last one."""
    running = with_block(with_bucket(changes, width), seq).withColumn(
        PAGES, running_in_block(F.col(PAGE), seq))
    blocks = running.groupBy(*BUCKET_KEY, BLOCK_NUMBER).agg(F.max(PAGES).alias(PAGES))
    return stitch(_uncut(blocks_joined(blocks)))


def routes_max_string(changes: DataFrame, seq: str | None = None,
                      width: int = BUCKET_SECONDS) -> DataFrame:
    """Longest running route string (A3): a prefix sorts below its extensions."""
    running = with_block(with_bucket(changes, width), seq).withColumn(
        ROUTE, join_route(running_in_block(F.col(PAGE), seq)))
    return _joined(
        running.groupBy(*BUCKET_KEY, BLOCK_NUMBER).agg(F.max(ROUTE).alias(ROUTE)), BUCKET, BLOCK_NUMBER)


def sorted_in_buckets(rows: DataFrame, seq: str | None) -> DataFrame:
    """Fragments of rows with their bucket: ``(order, page)`` structs, collected and sorted."""
    return _uncut(
        rows.groupBy(*BUCKET_KEY).agg(F.array_sort(F.collect_list(event_entry(seq))).alias(_XS))
        .select(*BUCKET_KEY, kept_pages(F.col(_XS), None).alias(PAGES)))


def routes_sorted(changes: DataFrame, seq: str | None = None,
                  width: int = BUCKET_SECONDS) -> DataFrame:
    """Collect ``(order, page)`` structs, sort the array, join the pages."""
    return stitch(sorted_in_buckets(with_bucket(changes, width), seq))


def routes_listagg(changes: DataFrame, seq: str | None = None,
                   width: int = BUCKET_SECONDS) -> DataFrame:
    """Join the pages with an ordered string aggregate: ``listagg ... WITHIN GROUP``."""
    order = ", ".join(f"`{c}`" for c in order_columns(seq))
    route = F.expr(f"listagg(`{PAGE}`, '{SEPARATOR}') WITHIN GROUP (ORDER BY {order})")
    return _joined(
        with_bucket(changes, width).groupBy(*BUCKET_KEY).agg(route.alias(ROUTE)), BUCKET)


def fragments(events: DataFrame, seq: str | None = None,
              width: int = BUCKET_SECONDS) -> DataFrame:
    """``user_id, session_id, bucket, cut, pages`` per bucket: its first error time, and its
    collapsed pages before that.

    One aggregate gives the error time and the set of events; sets are combined
    before the shuffle, so copies of an event cost nothing.
    """
    per_bucket = slim_events(events, seq, width).groupBy(*BUCKET_KEY).agg(
        error_time().alias(CUT), F.collect_set(event_entry(seq)).alias(_XS))
    # The page array is a column of its own: ``collapse_repeats`` reads it twice.
    pages = per_bucket.select(
        *BUCKET_KEY, CUT, kept_pages(F.array_sort(_XS)).alias(PAGES))
    return pages.withColumn(PAGES, collapse_repeats(PAGES))


def routes_fold(events: DataFrame, seq: str | None = None,
                width: int = BUCKET_SECONDS) -> DataFrame:
    """Cut, collapse and join per bucket with array functions only (U1, native form)."""
    return stitch(fragments(events, seq, width))


def routes_window(events: DataFrame, seq: str | None = None,
                  width: int = BUCKET_SECONDS) -> DataFrame:
    """Window-min cut and ``lag`` in one window pass per bucket, then the page changes.

    The cut keeps a prefix, so ``lag`` over the uncut rows equals ``lag`` over
    the kept rows: both functions share one sort.
    """
    ordered = Window.partitionBy(*BUCKET_KEY).orderBy(*order_columns(seq))
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    prev = "__trail_prev"
    marked = distinct_events(slim_events(events, seq, width)).withColumns({
        CUT: error_time().over(whole), prev: F.lag(PAGE).over(ordered)})
    change = (
        (F.col(CUT).isNull() | (F.col(TS) < F.col(CUT)))
        & (F.col(prev).isNull() | (F.col(PAGE) != F.col(prev)))
    )
    return stitch(
        marked.groupBy(*BUCKET_KEY)
        .agg(F.min(CUT).alias(CUT),
             F.array_sort(F.collect_list(F.when(change, event_entry(seq)))).alias(_XS))
        .select(*BUCKET_KEY, CUT, kept_pages(F.col(_XS), None).alias(PAGES)))

