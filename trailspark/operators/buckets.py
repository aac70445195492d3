"""Time buckets: a session is computed bucket by bucket and its pieces are stitched.

A bucket is ``timestamp`` rounded down to a multiple of the width, so bucket
order is time order and needs no sort. Operators work per ``(user_id,
session_id, bucket)``, which spreads one long session over many tasks, and
what a bucket needs from earlier ones (the first error, the last page) comes
from a table with one row per bucket. The width is a parameter that changes
no result.

What stays in one task: the distinct events of one session inside one width,
and one small row per bucket of a session. Rows with a null id (which the
readers reject, and whole queries filter) are one bucket, null, as no equality
finds their other buckets again; drop them first if there are many.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions import collapse_repeats, is_error, join_route
from ..schema import BUCKET_SECONDS, KEY, PAGE, ROUTE, SESSION, TS, USER, order_columns

# Helper columns are reserved names, so they never meet a caller's column.
BUCKET = "__trail_bucket"
CUT = "__trail_cut"
PAGES = "__trail_pages"
ERR = "__trail_error"
BUCKET_KEY = (*KEY, BUCKET)


def valid_events(events: DataFrame, seq: str | None = None) -> DataFrame:
    """The rows every reader would let through (V3, V7, V8): key, time, page and
    tie-break present, page not empty. A map-side filter."""
    ok = F.col(PAGE) != F.lit("")
    for c in (USER, SESSION, TS, *([seq] if seq else [])):
        ok = ok & F.col(c).isNotNull()
    return events.filter(ok)


def with_bucket(events: DataFrame, width: int = BUCKET_SECONDS) -> DataFrame:
    start = F.col(TS) - F.pmod(F.col(TS), F.lit(width))
    whole = F.col(USER).isNotNull() & F.col(SESSION).isNotNull()
    return events.withColumn(BUCKET, F.when(whole, start))


def slim_events(events: DataFrame, seq: str | None, width: int) -> DataFrame:
    """Valid events as bucket key, order columns, page and error flag."""
    cols = dict.fromkeys([*KEY, *order_columns(seq), PAGE])
    rows = with_bucket(valid_events(events, seq), width)
    return rows.select(*cols, BUCKET, is_error().alias(ERR))


def distinct_events(slim: DataFrame) -> DataFrame:
    """One row per event: exact copies are combined before the shuffle, so a mass of
    copies never fills a bucket; a copy that is an error makes the event one."""
    cols = [c for c in slim.columns if c != ERR]
    return slim.groupBy(*cols).agg(F.max(ERR).alias(ERR))


def error_time() -> Column:
    return F.min(F.when(F.col(ERR), F.col(TS)))


def event_entry(seq: str | None) -> Column:
    """Sortable struct: the order columns, which end with the page."""
    return F.struct(*order_columns(seq))


def kept_pages(entries: Column, cut: str | None = CUT) -> Column:
    """Pages of sorted ``entries`` before the cut, in order."""
    kept = entries if cut is None else F.filter(
        entries, lambda x: F.col(cut).isNull() | (x[TS] < F.col(cut)))
    return F.transform(kept, lambda x: x[PAGE])


def earlier_buckets() -> WindowSpec:
    """The session's buckets before each bucket, over a table with one row per bucket."""
    return Window.partitionBy(*KEY).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)


def stitch(fragments: DataFrame) -> DataFrame:
    """``user_id, session_id, route`` from ``(key, bucket, cut, pages)`` fragments.

    Fragments go in bucket order up to the first one with an error; a page
    repeated over a boundary collapses; sessions without pages give no row.
    """
    upto, parts = F.col("__trail_stop"), F.col("__trail_parts")
    kept = F.filter(parts, lambda x: upto.isNull() | (x[BUCKET] <= upto))
    return (
        fragments.groupBy(*KEY)
        .agg(
            F.min(F.when(F.col(CUT).isNotNull(), F.col(BUCKET))).alias("__trail_stop"),
            F.array_sort(F.collect_list(F.struct(BUCKET, PAGES))).alias("__trail_parts"),
        )
        .select(*KEY, F.flatten(F.transform(kept, lambda x: x[PAGES])).alias(PAGES))
        # A column of its own: ``collapse_repeats`` reads its array twice.
        .select(*KEY, collapse_repeats(PAGES).alias(PAGES))
        .filter(F.size(PAGES) > 0)
        .select(*KEY, join_route(PAGES).alias(ROUTE))
    )

