"""Page collapse: keep an event only when its page differs from the one before."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schema import BUCKET_SECONDS, KEY, PAGE, PREV_PAGE, order_columns
from .buckets import BUCKET, BUCKET_KEY, with_bucket
from .cut import cut_rows

_FIRST, _LAST = "__trail_first", "__trail_last"


def _changes(rows: DataFrame, columns: list[str], seq: str | None) -> DataFrame:
    """Page changes of rows with their bucket.

    ``lag`` runs per bucket. Its answer stands for every row but the first of
    a bucket; the first and last rows of all buckets, a small table, give those
    their predecessor by a second ``lag`` over the session. Both parts read the
    same shuffled rows, so the input is read once and joined with nothing.
    """
    if PREV_PAGE in columns:
        raise ValueError(f"the input has a column {PREV_PAGE}, which this adds; rename it first")
    in_bucket = Window.partitionBy(*BUCKET_KEY).orderBy(*order_columns(seq))
    marked = rows.withColumns({
        PREV_PAGE: F.lag(PAGE).over(in_bucket),
        _FIRST: F.row_number().over(in_bucket) == 1,
        _LAST: F.lead(F.lit(1)).over(in_bucket).isNull(),
    })
    # A bucket's first row comes before its last, if they are two.
    ends = Window.partitionBy(*KEY).orderBy(BUCKET, F.desc(_FIRST))
    firsts = (
        marked.filter(F.col(_FIRST) | F.col(_LAST))
        .withColumn(PREV_PAGE, F.lag(PAGE).over(ends))
        .filter(F.col(_FIRST))
    )
    change = F.col(PREV_PAGE).isNull() | (F.col(PAGE) != F.col(PREV_PAGE))
    # Columns of its own for either part: the optimizer would treat a union's first part
    # differently below its output, and the shuffled rows could not be shared.
    own = [F.col(f"`{c}`").alias(c) for c in (*columns, PREV_PAGE)]
    return (marked.filter(~F.col(_FIRST) & change).select(*own)
            .unionByName(firsts.filter(change).select(*own)))


def page_changes(events: DataFrame, seq: str | None = None,
                 width: int = BUCKET_SECONDS) -> DataFrame:
    """Rows where the page changes, with ``prev_event_page``.

    The order is the total order ``(timestamp, seq)`` (or ``(timestamp,
    event_page)``), so ties cannot make the result depend on input order.
    """
    return _changes(with_bucket(events, width), events.columns, seq)


def surviving_changes(events: DataFrame, seq: str | None = None,
                      width: int = BUCKET_SECONDS) -> DataFrame:
    """``page_changes`` over the rows before the error cut, in one shuffle of the events:
    cut and collapse work on the same buckets."""
    return _changes(cut_rows(with_bucket(events, width)), events.columns, seq)


def bucket_changes(events: DataFrame, seq: str | None = None,
                   width: int = BUCKET_SECONDS) -> DataFrame:
    """Rows that begin a time bucket or change the page in it, with the bucket.

    For callers that collapse once more over the boundaries (``stitch``).
    """
    return changes_in_buckets(with_bucket(events, width), seq)


def changes_in_buckets(rows: DataFrame, seq: str | None = None) -> DataFrame:
    """``bucket_changes`` of rows that have their bucket."""
    prev = "__trail_before"
    w = Window.partitionBy(*BUCKET_KEY).orderBy(*order_columns(seq))
    return (
        rows.withColumn(prev, F.lag(PAGE).over(w))
        .filter(F.col(prev).isNull() | (F.col(PAGE) != F.col(prev)))
        .drop(prev)
    )
