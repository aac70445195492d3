"""Adapter from the generic ``events`` Parquet table to the clickstream schema.

``events`` has ``event_id, ts, user_id, event_type, value, props`` (props is
JSON with an integer ``k``). Mapping: sessions are ``days``-long calendar
slices of ``ts``; the clock is whole seconds coarsened to ``unit``; the page is
``'p' || k % 4``; ``event_id`` is the tie-break ``seq``. Time is computed on
``timestamp_ntz`` so the session time zone cannot shift any value.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailspark.schema import PAGE, SEQ, SESSION, TS, TYPE, USER

PAGES = 4


# Whole seconds since 1970 on the wall clock of ``ts``.
EPOCH_SECONDS = "timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', CAST(ts AS TIMESTAMP_NTZ))"


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def events_from_table(events: DataFrame, days: int = 1, unit: int = 1,
                      extra: tuple[str, ...] = ()) -> DataFrame:
    """Clickstream view of ``events``; rows with a null key, time or page are dropped.

    ``extra`` carries source columns through unchanged (e.g. ``value``).
    """
    # json_tuple parses each props text once (a generator), where repeated
    # get_json_object calls would be re-evaluated by every pushed-down filter.
    parsed = events.select("*", F.json_tuple(F.col("props"), "k").alias("_k"))
    k = F.col("_k").try_cast("int")
    out = parsed.select(
        F.col("user_id").alias(USER),
        F.expr(f"{EPOCH_SECONDS} div {86400 * days}").alias(SESSION),
        F.col("event_type").alias(TYPE),
        F.concat(F.lit("p"), (k % PAGES).cast("string")).alias(PAGE),
        (F.expr(f"{EPOCH_SECONDS} div {unit}") * unit).alias(TS),
        F.col("event_id").alias(SEQ),
        *[F.col(c) for c in extra],
    )
    return out.filter(
        F.col(USER).isNotNull() & F.col(SESSION).isNotNull() & F.col(TS).isNotNull()
        & F.col(PAGE).isNotNull() & F.col(SEQ).isNotNull()
    )


def load_events(spark: SparkSession, sf_dir: str, days: int = 1, unit: int = 1,
                extra: tuple[str, ...] = ()) -> DataFrame:
    return events_from_table(spark.read.parquet(table_path(sf_dir, "events")), days, unit, extra)


def adapter_sql(days: int = 1, unit: int = 1, table: str = "events",
                extra: tuple[str, ...] = ()) -> str:
    """The same mapping as a DuckDB ``SELECT`` (used by the oracle)."""
    secs = "CAST(floor(epoch(ts)) AS BIGINT)"
    carried = "".join(f",\n       {c}" for c in extra)
    return f"""SELECT user_id AS {USER},
       {secs} // {86400 * days} AS {SESSION},
       event_type AS {TYPE},
       'p' || CAST(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) % {PAGES} AS VARCHAR) AS {PAGE},
       {secs} // {unit} * {unit} AS {TS},
       event_id AS {SEQ}{carried}
FROM {table}
WHERE user_id IS NOT NULL AND ts IS NOT NULL AND event_id IS NOT NULL
  AND TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) IS NOT NULL"""


# Fault injection for the line parser, keyed on ``value``: below each bound
# the line is damaged in one way; from the last bound up it stays clean.
DAMAGE_BOUNDS = {"missing_field": 2.0, "extra_field": 4.0, "bad_number": 6.0, "empty_page": 8.0}


def damaged_lines(events: DataFrame, seq: str = SEQ) -> DataFrame:
    """Tab-joined lines of ``events`` (which must carry ``value``), some damaged on purpose."""
    def s(c: str):
        return F.coalesce(F.col(c).cast("string"), F.lit(""))

    fields = [s(USER), s(SESSION), s(TYPE), s(PAGE), s(TS), s(seq)]
    value = F.col("value")
    b = DAMAGE_BOUNDS
    line = (
        F.when(value < b["missing_field"], F.concat_ws("\t", *fields[:-1]))
        .when(value < b["extra_field"], F.concat_ws("\t", *fields, F.lit("extra")))
        .when(value < b["bad_number"], F.concat_ws("\t", *fields[:4], F.lit("bad"), fields[5]))
        .when(value < b["empty_page"], F.concat_ws("\t", *fields[:3], F.lit(""), *fields[4:]))
        .otherwise(F.concat_ws("\t", *fields))
    )
    return events.select(line.alias("value"))


# Event type whose rows are all moved into one session by ``skewed_events``
# (about a fifth of the table).
HOT_TYPE = "view"


def skewed_events(events: DataFrame) -> DataFrame:
    """Move every ``view`` event into session ``(0, 0)``: one session holds a large share of rows."""
    hot = F.col(TYPE) == F.lit(HOT_TYPE)
    return events.withColumns({
        USER: F.when(hot, F.lit(0)).otherwise(F.col(USER)),
        SESSION: F.when(hot, F.lit(0)).otherwise(F.col(SESSION)),
    })


def skewed_sql(adapter: str) -> str:
    """``skewed_events`` over an adapter ``SELECT`` (DuckDB)."""
    return f"""SELECT CASE WHEN {TYPE} = '{HOT_TYPE}' THEN 0 ELSE {USER} END AS {USER},
       CASE WHEN {TYPE} = '{HOT_TYPE}' THEN 0 ELSE {SESSION} END AS {SESSION},
       {TYPE}, {PAGE}, {TS}, {SEQ}
FROM ({adapter}) a"""


# Rows made invalid by ``event_id``: what a reader would have rejected.
def dirty_events(events: DataFrame) -> DataFrame:
    """Null or empty keys, times, tie-breaks and pages in about half of the rows, by ``seq``."""
    kind = F.pmod(F.col(SEQ), F.lit(13))
    null = F.lit(None)
    return events.withColumns({
        USER: F.when(kind != 0, F.col(USER)).otherwise(null),
        SESSION: F.when(kind != 1, F.col(SESSION)).otherwise(null),
        TS: F.when(kind != 2, F.col(TS)).otherwise(null),
        PAGE: F.when(kind == 3, F.lit("")).when(kind != 4, F.col(PAGE)),
        SEQ: F.when(kind != 5, F.col(SEQ)).otherwise(null),
    })


def clean_sql(adapter: str) -> str:
    """The rows of an adapter ``SELECT`` that ``dirty_events`` leaves valid (DuckDB)."""
    return f"SELECT * FROM ({adapter}) a WHERE {SEQ} % 13 NOT IN (0, 1, 2, 3, 4, 5)"


# Pages whose names a careless text sink would change: outer blanks, quotes,
# backslashes, tabs, line feeds.
ODD_PAGES = {"p0": " main ", "p1": 'a"b\\', "p2": "tab\there\\t", "p3": "l\nf\r"}


def odd_pages(events: DataFrame) -> DataFrame:
    page = F.col(PAGE)
    for name, odd in ODD_PAGES.items():
        page = F.when(F.col(PAGE) == name, F.lit(odd)).otherwise(page)
    return events.withColumn(PAGE, page)


def odd_sql(adapter: str) -> str:
    """``odd_pages`` over an adapter ``SELECT`` (DuckDB)."""
    def text(odd: str) -> str:
        return " || ".join(f"chr({ord(c)})" for c in odd)

    cases = " ".join(f"WHEN '{name}' THEN {text(odd)}" for name, odd in ODD_PAGES.items())
    return f"""SELECT {USER}, {SESSION}, {TYPE}, CASE {PAGE} {cases} ELSE {PAGE} END AS {PAGE}, {TS}, {SEQ}
FROM ({adapter}) a"""


def mixed_types(events: DataFrame) -> DataFrame:
    """User and tie-break as text (``bad`` where there is none), the rest as it is."""
    return events.withColumns({
        c: F.coalesce(F.col(c).cast("string"), F.lit("bad")) for c in (USER, SEQ)})
