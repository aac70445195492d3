"""The route query as one Spark SQL statement over a registered events view (Q4).

The same plan as the ``fold`` form: one scan, one aggregate per time bucket,
one per session to stitch the buckets. ``n`` and ``width`` are bound
parameters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.exprs import LONG_PATTERN
from ..operators.counts import DEFAULT_N
from ..schema import BUCKET_SECONDS, PAGE, SESSION, TS, USER, order_columns


def _long(column: str, kind: str) -> str:
    """``column`` of type ``kind`` as a number, by the readers' rule."""
    if kind == "bigint":
        return column
    if kind != "string":
        return f"TRY_CAST({column} AS BIGINT)"
    return f"CASE WHEN {column} RLIKE '{LONG_PATTERN}' THEN TRY_CAST({column} AS BIGINT) END"


def _collapsed(pages: str) -> str:
    return (
        f"array_compact(zip_with({pages}, concat(array(CAST(NULL AS STRING)), {pages}), "
        "(cur, prev) -> CASE WHEN prev IS NULL OR cur <> prev THEN cur END))"
    )


def top_routes_sql_text(view: str, seq: str | None = None,
                        kinds: dict[str, str] | None = None) -> str:
    """The statement. ``kinds`` are the types of the view's columns, a string where it has
    none: each column is cast, or passed through, by its own. Rows with a missing or
    unparsable key, time, tie-break or page are left out."""
    kinds = kinds or {}
    user, session, time, tie = (_long(c, kinds.get(c, "string")) for c in (
        USER, SESSION, TS, order_columns(seq)[1]))
    if not seq:
        tie = PAGE
    return f"""
WITH typed AS (
    SELECT {user} AS user_id, {session} AS session_id, {time} AS timestamp,
           {tie} AS tie, event_page,
           coalesce(lower(event_type) LIKE '%error%', false) AS is_error
    FROM {view}
),
base AS (
    SELECT *, timestamp - pmod(timestamp, :width) AS bucket
    FROM typed
    WHERE user_id IS NOT NULL AND session_id IS NOT NULL AND timestamp IS NOT NULL
      AND tie IS NOT NULL AND event_page <> ''
),
buckets AS (
    -- a set: copies of an event are combined before the shuffle
    SELECT user_id, session_id, bucket,
           MIN(CASE WHEN is_error THEN timestamp END) AS cut,
           array_sort(collect_set(struct(timestamp, tie, event_page))) AS events
    FROM base
    GROUP BY user_id, session_id, bucket
),
kept AS (
    SELECT user_id, session_id, bucket, cut,
           transform(filter(events, e -> cut IS NULL OR e.timestamp < cut),
                     e -> e.event_page) AS pages
    FROM buckets
),
fragments AS (
    SELECT user_id, session_id, bucket, cut, {_collapsed("pages")} AS pages FROM kept
),
sessions AS (
    SELECT user_id, session_id, MIN(CASE WHEN cut IS NOT NULL THEN bucket END) AS stop,
           array_sort(collect_list(struct(bucket, pages))) AS parts
    FROM fragments
    GROUP BY user_id, session_id
),
stitched AS (
    SELECT flatten(transform(filter(parts, p -> stop IS NULL OR p.bucket <= stop),
                             p -> p.pages)) AS pages
    FROM sessions
),
routes AS (
    SELECT array_join({_collapsed("pages")}, '-') AS route FROM stitched WHERE size(pages) > 0
)
SELECT route, COUNT(*) AS count
FROM routes
GROUP BY route
ORDER BY count DESC, route ASC
LIMIT :n
"""


def top_routes_sql(spark: SparkSession, view: str = "clickstream", n: int = DEFAULT_N,
                   seq: str | None = None, width: int = BUCKET_SECONDS) -> DataFrame:
    """Run the statement over ``view``: a typed events view (``register_events_view``),
    one with string columns, as a header-only CSV read gives, or any mix of both."""
    kinds = dict(spark.table(view).dtypes)
    return spark.sql(top_routes_sql_text(view, seq, kinds), args={"n": n, "width": width})
