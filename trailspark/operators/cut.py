"""Error cut: drop every event at or after the first error of its session.

Four equivalent forms:

* ``cut_window`` — running error count over a RANGE frame ordered by time, so
  events in the same second as the error see it (the reference's window form);
* ``cut_partition_min`` — minimum of error times over the whole partition;
* ``cut_join`` — first error (partial + final aggregate) joined back with a left
  outer equi-join, strategy left to the planner / AQE;
* ``cut_broadcast`` — the same join; AQE broadcasts the error table when its
  measured size allows, or always, one row per session, if the caller vouches
  for its size.

They run per time bucket (see ``buckets``): a table with one row per bucket says
what earlier buckets of the session found, and rows are joined with it by
``(session, bucket)``, so a session of any length is spread over tasks. (A join
by session would hold a long one in one task: AQE splits skewed partitions only
where both sides come straight from an exchange, and an aggregate does not.)

The joins are by equality, so rows with a null id have no cut in the join
forms; the window forms treat equal ids, nulls included, as one session.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import is_error
from ..schema import BUCKET_SECONDS, ERROR_TS, KEY, TS, order_columns
from .buckets import BUCKET_KEY, CUT, earlier_buckets, with_bucket

_COUNT, _BEFORE = "__trail_errors", "__trail_before"


def error_events(events: DataFrame) -> DataFrame:
    """Rows whose type marks a browser error (F1)."""
    return events.filter(is_error())


def first_error(events: DataFrame) -> DataFrame:
    """``user_id, session_id, error_timestamp`` for sessions with an error (A1).

    The filter runs before the aggregate, and the aggregate is partial then
    final, so a hot session costs one row per map task in the shuffle.
    """
    return error_events(events).groupBy(*KEY).agg(F.min(TS).alias(ERROR_TS))


def _from_earlier(rows: DataFrame, of_bucket: Column, over_earlier) -> DataFrame:
    """``rows`` joined with what the session's earlier buckets hold, as ``_BEFORE``.

    The table reads the columns of keys, time and type only, and is combined
    before its shuffle.
    """
    table = (
        rows.groupBy(*BUCKET_KEY).agg(of_bucket.alias(_BEFORE))
        .select(*BUCKET_KEY, over_earlier(F.col(_BEFORE)).over(earlier_buckets()).alias(_BEFORE))
    )
    return rows.join(table, list(BUCKET_KEY), "left")


def _error_time() -> Column:
    return F.when(is_error(), F.col(TS))


def first_error_by_bucket(rows: DataFrame) -> DataFrame:
    """``(user_id, session_id, bucket, cut)``: the first error of the session up to each of
    its buckets, where there is one (A1, spread over the buckets of ``rows``)."""
    found = rows.groupBy(*BUCKET_KEY).agg(F.min(_error_time()).alias(CUT))
    before = F.min(CUT).over(earlier_buckets())
    return (found.select(*BUCKET_KEY, F.least(CUT, before).alias(CUT))
            .filter(F.col(CUT).isNotNull()))


def cut_window(events: DataFrame, seq: str | None = None,
               width: int = BUCKET_SECONDS) -> DataFrame:
    """Keep rows whose running error count is 0 over a RANGE frame by time."""
    w = (
        Window.partitionBy(*BUCKET_KEY)
        .orderBy(TS)
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    flag = F.when(is_error(), 1).otherwise(0)
    rows = _from_earlier(with_bucket(events, width), F.sum(flag), F.sum)
    return (
        rows.withColumn(_COUNT, F.sum(flag).over(w) + F.coalesce(_BEFORE, F.lit(0)))
        .filter(F.col(_COUNT) == 0)
        .select(*events.columns)
    )


def cut_partition_min(events: DataFrame, seq: str | None = None,
                      width: int = BUCKET_SECONDS) -> DataFrame:
    """Keep rows before the first error time, a minimum over the whole partition."""
    w = (
        Window.partitionBy(*BUCKET_KEY)
        .orderBy(*order_columns(seq))
        .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    at = _error_time()
    rows = _from_earlier(with_bucket(events, width), F.min(at), F.min)
    return (
        rows.withColumn(CUT, F.least(F.min(at).over(w), F.col(_BEFORE)))
        .filter(F.col(CUT).isNull() | (F.col(TS) < F.col(CUT)))
        .select(*events.columns)
    )


def _before_cut(rows: DataFrame, cuts: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """``rows`` left joined with their cut, and the rows before it."""
    return (
        rows.join(cuts, list(key), "left")
        .filter(F.col(CUT).isNull() | (F.col(TS) < F.col(CUT)))
        .drop(CUT)
    )


def cut_rows(rows: DataFrame) -> DataFrame:
    """The rows of a frame with its bucket column before their session's first error."""
    return _before_cut(rows, first_error_by_bucket(rows), BUCKET_KEY)


def cut_join(events: DataFrame, seq: str | None = None,
             width: int = BUCKET_SECONDS) -> DataFrame:
    """Left outer join with the first-error table, then ``ts < error_ts``."""
    return cut_rows(with_bucket(events, width)).select(*events.columns)


def cut_broadcast(events: DataFrame, seq: str | None = None, hint: bool = False,
                  width: int = BUCKET_SECONDS) -> DataFrame:
    """The join as a broadcast join.

    The error table grows with the sessions, so its size is left to AQE: it broadcasts the
    table of ``cut_join`` when its measured bytes are within the session's threshold, and
    joins by bucket beyond that. ``hint=True`` broadcasts one row per session with an error,
    whatever that measures; no event is moved then.
    """
    if not hint:
        return cut_join(events, seq, width)
    errors = first_error(events).withColumnRenamed(ERROR_TS, CUT)
    return _before_cut(events, F.broadcast(errors), KEY).select(*events.columns)
