"""Result sinks: one ordered JSON object, tab-separated lines, a bounded dict.

The single-object JSON and the dict hold the top ``n`` routes only, so what
reaches one task or the driver is bounded by ``n``. The TSV sink writes any
size of table in parallel, range-sorted across part files.

TSV lines keep any text: a backslash, tab, line feed or carriage return inside
a route is written as ``\\\\``, ``\\t``, ``\\n`` or ``\\r``, a null route as
``\\N``; nothing is quoted or trimmed. ``read_tsv`` is the inverse.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.exprs import parse_long
from .operators.counts import DEFAULT_N, top_n
from .schema import COUNT, ROUTE

JSON = "json"
# Sinks never replace a folder unless the caller says so.
FAIL = "errorifexists"


def routes_json(counts: DataFrame, n: int = DEFAULT_N) -> DataFrame:
    """One row, one column ``json``: ``{"route": count, ...}`` in descending count.

    Built on Spark: top ``n``, then one small aggregate collects the ``n``
    entries, sorts them by ``(-count, route)`` and renders an ordered map.
    """
    top = top_n(counts, n)
    entry = F.struct((-F.col(COUNT)).alias("k"), F.col(ROUTE).alias("r"), F.col(COUNT).alias("c"))
    ordered = F.array_sort(F.collect_list(entry))
    pairs = F.transform(ordered, lambda x: F.struct(x["r"].alias("key"), x["c"].alias("value")))
    return top.agg(F.to_json(F.map_from_entries(pairs)).alias(JSON))


def write_json(counts: DataFrame, path: str, n: int | None = DEFAULT_N,
               mode: str = FAIL) -> str:
    """With ``n``: one ``{"route": count, ...}`` object (top ``n``). Without:
    the whole table as JSON lines, written in parallel in descending order."""
    if n is None:
        counts.orderBy(F.desc(COUNT), F.asc(ROUTE)).write.mode(mode).json(path)
    else:
        routes_json(counts, n).write.mode(mode).text(path)
    return path


# What stands for what in a TSV field. The backslash comes first: it is
# escaped before it is used to escape.
BACKSLASH, TAB, NULL = "\\", "\t", "\\N"
ESCAPES = {BACKSLASH: "\\\\", TAB: "\\t", "\n": "\\n", "\r": "\\r"}


def escape_field(text: Column) -> Column:
    """``text`` as one TSV field."""
    out = text
    for raw, escaped in ESCAPES.items():
        out = F.replace(out, F.lit(raw), F.lit(escaped))
    return F.coalesce(out, F.lit(NULL))


def unescape_field(field: Column) -> Column:
    """The text of a TSV field. Doubled backslashes are split off first, from the
    left, so what remains between them are single escapes."""
    def single(part: Column) -> Column:
        for raw, escaped in ESCAPES.items():
            if raw != BACKSLASH:
                part = F.replace(part, F.lit(escaped), F.lit(raw))
        return part

    parts = F.split(field, r"\\\\", -1)
    return F.when(field != NULL, F.array_join(F.transform(parts, single), BACKSLASH))


def tsv_lines(counts: DataFrame) -> DataFrame:
    """``route<TAB>count`` per row, in a column ``value``."""
    count = F.coalesce(F.col(COUNT).cast("string"), F.lit(NULL))
    return counts.select(F.concat(escape_field(F.col(ROUTE)), F.lit(TAB), count).alias("value"))


def write_tsv(counts: DataFrame, path: str, n: int | None = None, mode: str = FAIL) -> str:
    """``route<TAB>count`` lines in descending count.

    With ``n`` the top-n goes to one file; without, the whole table is written
    by a distributed sort (range-partitioned part files, in order).
    """
    if n is not None:
        out = top_n(counts, n).coalesce(1).sortWithinPartitions(F.desc(COUNT), F.asc(ROUTE))
    else:
        out = counts.orderBy(F.desc(COUNT), F.asc(ROUTE))
    tsv_lines(out).write.mode(mode).option("lineSep", "\n").text(path)
    return path


def read_tsv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The ``route, count`` table that ``write_tsv`` wrote.

    Lines without exactly one tab or with a count that is no number are left out.
    """
    fields = F.split(F.col("value"), TAB, -1)
    lines = spark.read.option("lineSep", "\n").text(path).select(fields.alias("f"))
    count = F.get("f", 1)
    return (
        lines.filter((F.size("f") == 2) & ((count == NULL) | parse_long(count).isNotNull()))
        .select(unescape_field(F.get("f", 0)).alias(ROUTE), parse_long(F.get("f", 1)).alias(COUNT))
    )


def top_routes_dict(counts: DataFrame, n: int = DEFAULT_N) -> dict[str, int]:
    """``{route: count}`` of the top ``n`` (S8); at most ``n`` rows reach the driver."""
    return {r[ROUTE]: r[COUNT] for r in top_n(counts, n).collect()}
