"""Column names and the event schema every operator works on.

An event row is ``user_id, session_id, event_type, event_page, timestamp``
with an optional tie-break column (``seq`` by convention) that orders events
inside one second. Without one, ties go by ``event_page``.
"""

from __future__ import annotations

from pyspark.sql import types as T

USER = "user_id"
SESSION = "session_id"
TYPE = "event_type"
PAGE = "event_page"
TS = "timestamp"
SEQ = "seq"

# Session key: a session is every event sharing these two values,
# wherever it sits in the input.
KEY = (USER, SESSION)

# Output column names.
ROUTE = "route"
COUNT = "count"
ERROR_TS = "error_timestamp"
PREV_PAGE = "prev_event_page"

# Route separator.
SEPARATOR = "-"

# Width of the time buckets a session is computed in (see operators.buckets).
# It bounds what one task holds of a session and changes no result.
BUCKET_SECONDS = 3600

EVENT_FIELDS = (USER, SESSION, TYPE, PAGE, TS)


def events_schema(seq: str | None = None) -> T.StructType:
    """Typed schema of the delimited input; ``seq`` appends a tie-break column."""
    fields = [
        T.StructField(USER, T.LongType()),
        T.StructField(SESSION, T.LongType()),
        T.StructField(TYPE, T.StringType()),
        T.StructField(PAGE, T.StringType()),
        T.StructField(TS, T.LongType()),
    ]
    if seq:
        fields.append(T.StructField(seq, T.LongType()))
    return T.StructType(fields)


def event_columns(seq: str | None = None) -> list[str]:
    return list(EVENT_FIELDS) + ([seq] if seq else [])


def order_columns(seq: str | None = None) -> list[str]:
    """Total order of events inside a session: time, the tie-break, the page.

    The page comes last so that even a tie-break with repeated values orders
    every row the same way in every form; rows equal on all three are
    interchangeable for the route.
    """
    return [TS, seq, PAGE] if seq else [TS, PAGE]


ROUTE_COUNTS_SCHEMA = T.StructType(
    [T.StructField(ROUTE, T.StringType()), T.StructField(COUNT, T.LongType())]
)

SESSION_ROUTES_SCHEMA = T.StructType(
    [
        T.StructField(USER, T.LongType()),
        T.StructField(SESSION, T.LongType()),
        T.StructField(ROUTE, T.StringType()),
    ]
)
