"""The route query as DataFrame plans: session routes in several physical shapes, then top-n.

Forms (all give the same table; see tests/test_cross_forms.py):

=========== ===================================================================
``fold``    one aggregate per time bucket collecting the set of events, then
            array functions only (default)
``window``  window-min cut + ``lag`` in one window pass over one sort
``windows`` the reference's DataFrame shape: running error sum (RANGE frame),
            ``lag``, running ``collect_list`` per block, ``max`` of the lists
``join``    first-error aggregate, left outer join by bucket, ``lag``, collect
            + sort
``broadcast`` as ``join``: AQE broadcasts the error table by its measured size
            and else joins by bucket (``cut_broadcast(hint=True)`` forces it)
``pandas``  cluster + sort by bucket, vectorized ``mapInPandas`` fold
=========== ===================================================================

Every form filters the input by one rule (``valid_events``), works per time
bucket and stitches a session's fragments; a session's events never meet in
one task. ``width`` (seconds) is the bucket width; it changes no result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.buckets import (
    BUCKET_KEY,
    CUT,
    ERR,
    PAGES,
    distinct_events,
    error_time,
    slim_events,
    stitch,
    valid_events,
    with_bucket,
)
from ..operators.collapse import changes_in_buckets
from ..operators.counts import DEFAULT_N, route_counts, top_n
from ..operators.cut import cut_rows
from ..operators.pandas_fold import routes_pandas
from ..operators.paths import (
    BLOCK_NUMBER,
    blocks_joined,
    routes_fold,
    routes_window,
    running_in_block,
    sorted_in_buckets,
    with_block,
)
from ..schema import BUCKET_SECONDS, PAGE, TS, order_columns

RouteForm = Callable[[DataFrame, "str | None", int], DataFrame]


def _windows(events: DataFrame, seq: str | None, width: int) -> DataFrame:
    """The reference's three windows (running error sum, ``lag``, running list) per bucket.

    ``lag`` (ordered by the full order) is computed before the RANGE error
    sum (ordered by time only), so one sort serves both. The running lists are
    per block of a bucket, and the longest ones of its blocks make its pages.
    """
    ordered = Window.partitionBy(*BUCKET_KEY).orderBy(*order_columns(seq))
    by_time = (
        Window.partitionBy(*BUCKET_KEY)
        .orderBy(TS)
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    prev, errors = "__trail_prev", "__trail_errors"
    marked = (
        with_block(distinct_events(slim_events(events, seq, width)), seq)
        .withColumn(prev, F.lag(PAGE).over(ordered))
        .withColumn(errors, F.sum(F.when(F.col(ERR), 1).otherwise(0)).over(by_time))
    )
    change = (F.col(errors) == 0) & (F.col(prev).isNull() | (F.col(PAGE) != F.col(prev)))
    blocks = (
        marked.withColumn(PAGES, running_in_block(F.when(change, F.col(PAGE)), seq))
        .groupBy(*BUCKET_KEY, BLOCK_NUMBER)
        .agg(error_time().alias(CUT), F.max(PAGES).alias(PAGES))
    )
    return stitch(blocks_joined(blocks, F.min(CUT).alias(CUT)))


def _changed(cut: DataFrame, seq: str | None) -> DataFrame:
    """Routes from the cut rows with their bucket: changes per bucket, collected and sorted."""
    return stitch(sorted_in_buckets(changes_in_buckets(cut, seq), seq))


def _join(events: DataFrame, seq: str | None, width: int) -> DataFrame:
    """Joined rows stay in the partitions of their bucket for the window that follows."""
    return _changed(cut_rows(with_bucket(valid_events(events, seq), width)), seq)


FORMS: dict[str, RouteForm] = {
    "fold": routes_fold,
    "window": routes_window,
    "windows": _windows,
    "join": _join,
    "broadcast": _join,
    "pandas": routes_pandas,
}

DEFAULT_FORM = "fold"


def session_routes(events: DataFrame, form: str = DEFAULT_FORM, seq: str | None = None,
                   width: int = BUCKET_SECONDS) -> DataFrame:
    """``user_id, session_id, route`` for every session with a surviving event."""
    return FORMS[form](events, seq, width)


def all_route_counts(events: DataFrame, form: str = DEFAULT_FORM, seq: str | None = None,
                     width: int = BUCKET_SECONDS) -> DataFrame:
    """The full ``route, count`` table."""
    return route_counts(session_routes(events, form, seq, width))


def top_routes(events: DataFrame, n: int = DEFAULT_N, form: str = DEFAULT_FORM,
               seq: str | None = None, width: int = BUCKET_SECONDS) -> DataFrame:
    """The ``n`` most frequent session routes (flagship)."""
    return top_n(all_route_counts(events, form, seq, width), n)
