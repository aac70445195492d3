"""Tab-separated clickstream sources: typed reader, text-line parser, SQL view, RDD facade.

Malformed input is never silently repaired. A line is clean when it has exactly
the expected number of fields, every number parses, and the ids, the
timestamp and the page are present; everything else goes to the rejects.
"""

from __future__ import annotations

from functools import reduce

from pyspark import RDD, SparkContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import LONG_PATTERN, parse_long
from ..schema import EVENT_FIELDS, PAGE, SESSION, TS, USER, event_columns, events_schema
from .headers import by_header

CORRUPT = "_corrupt_record"
LINE = "value"
DELIMITER = "\t"


def header_line(seq: str | None = None) -> str:
    return DELIMITER.join(event_columns(seq))


def _longs(seq: str | None) -> list[str]:
    return [USER, SESSION, TS] + ([seq] if seq else [])


def _check_columns(names: list[str], seq: str | None, where: object) -> None:
    if missing := [c for c in event_columns(seq) if c not in names]:
        raise ValueError(f"columns {missing} are missing in {where}, which has {names}")


def _typed_columns(df: DataFrame, seq: str | None) -> dict[str, Column]:
    """The event columns of ``df`` by name, numbers in text by the one rule of ``parse_long``."""
    kinds = dict(df.dtypes)
    typed = {c: F.col(f"`{c}`") for c in event_columns(seq)}
    for c in _longs(seq):
        typed[c] = parse_long(typed[c]) if kinds[c] == "string" else typed[c].try_cast("bigint")
    typed[PAGE] = F.nullif(typed[PAGE], F.lit(""))
    return typed


def _split_clean(df: DataFrame, seq: str | None, also: Column) -> tuple[DataFrame, DataFrame]:
    """``(clean, rejects)``: typed rows with every required value, and the other rows as read."""
    typed = _typed_columns(df, seq)
    ok = also
    for c in [*_longs(seq), PAGE]:
        ok = ok & typed[c].isNotNull()
    clean = df.filter(ok).select(*[v.alias(k) for k, v in typed.items()])
    return clean, df.filter(~F.coalesce(ok, F.lit(False)))


def _reader(spark: SparkSession, quote: str | None):
    reader = (
        spark.read.option("header", "true").option("sep", DELIMITER).option("encoding", "UTF-8")
    )
    return reader if quote is None else reader.option("quote", quote)


def _both(parts: list[tuple[DataFrame, DataFrame]]) -> tuple[DataFrame, DataFrame]:
    """``(clean, rejects)`` of several scans, in one frame each."""
    clean, rejects = zip(*parts, strict=True)
    # Rejects keep their own columns; a column that another scan lacks is null there.
    return (reduce(DataFrame.unionByName, clean),
            reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rejects))


def _typed_scan(spark: SparkSession, path: str | list[str], seq: str | None,
                quote: str | None) -> tuple[DataFrame, DataFrame]:
    """``(clean, rejects)`` of files with one header."""
    names = _reader(spark, quote).csv(path).columns
    _check_columns(names, seq, path)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, CORRUPT]])
    raw = (
        _reader(spark, quote).schema(schema)
        .option("enforceSchema", "false")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        # Judge every line on all fields, whatever the query selects; with
        # pruning on, count() and collect() disagree on which lines are bad.
        .option("columnPruning", "false")
        .csv(path)
    )
    return _split_clean(raw, seq, F.col(CORRUPT).isNull())


def read_events_with_rejects(spark: SparkSession, path: str | list[str], seq: str | None = None,
                             quote: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Typed delimited scan (S1). Returns ``(clean, rejects)``.

    Columns are found by their header name, in any order and among others, in
    every file by its own header (see ``by_header``); a missing one raises.
    Input should be uncompressed or in a splittable codec: a gzip file is
    read by one task however large it is.

    Wrong field counts land in ``_corrupt_record``; numbers that do not parse
    and null or empty ids, timestamps and pages are rejected too.
    """
    groups = by_header(spark, path)
    if not groups:  # no file has a line
        empty = spark.createDataFrame([], events_schema(seq))
        return empty, empty.select(F.lit("").alias(CORRUPT)).limit(0)
    return _both([_typed_scan(spark, files, seq, quote) for _, files in groups])


def read_events(spark: SparkSession, path: str | list[str], seq: str | None = None,
                quote: str | None = None) -> DataFrame:
    return read_events_with_rejects(spark, path, seq, quote)[0]


def cast_events_with_rejects(df: DataFrame, seq: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Type a string-typed events frame (PJ1a) by the readers' rules.

    Returns ``(clean, rejects)``; a value that does not parse rejects its row
    instead of failing the job.
    """
    _check_columns(df.columns, seq, "the frame")
    return _split_clean(df, seq, F.lit(True))


def cast_events(df: DataFrame, seq: str | None = None) -> DataFrame:
    return cast_events_with_rejects(df, seq)[0]


def register_events_view(spark: SparkSession, path: str | list[str], view_name: str = "clickstream",
                         seq: str | None = None, quote: str | None = None) -> DataFrame:
    """Typed scan registered as a temp view for SQL."""
    df = read_events(spark, path, seq, quote)
    df.createOrReplaceTempView(view_name)
    return df


def _line_ok(parts: Column, names: list[str], seq: str | None) -> Column:
    """One expression over the split line: right arity and every field valid.

    Kinds of fields: "l" a long, "s" a non-empty string, "t" any text.
    ``zip_with`` pads the shorter array with nulls, so a missing field fails
    its check and an extra field meets a null kind; the line array is
    referenced once, so a pushed-down filter splits each line once.
    """
    kind = {PAGE: "s"} | dict.fromkeys(_longs(seq), "l")
    kinds = F.array(*[F.lit(kind.get(c, "t")) for c in names])

    def valid(x: Column, k: Column) -> Column:
        check = (
            F.when(k == "l", x.rlike(LONG_PATTERN) & x.try_cast("bigint").isNotNull())
            .when(k == "s", x != F.lit(""))
            .when(k == "t", x.isNotNull())
        )
        return F.coalesce(check, F.lit(False))

    return F.forall(F.zip_with(parts, kinds, valid), lambda ok: ok)


def parse_lines_with_rejects(lines: DataFrame, seq: str | None = None, line_col: str = LINE,
                             header: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Parse raw lines with column expressions (S4): split, arity check, typing.

    ``header`` names the fields in their order (default: the canonical one);
    lines equal to it are dropped. Returns ``(clean, rejects)``; rejects keep
    the raw line.
    """
    header = header_line(seq) if header is None else header
    names = header.split(DELIMITER)
    _check_columns(names, seq, "the header line")
    line = F.col(line_col)
    body = lines.filter(line != F.lit(header))
    ok = _line_ok(F.split(line, DELIMITER, -1), names, seq)
    parts = F.col("_parts")

    def field(c: str) -> Column:
        x = F.nullif(F.get(parts, names.index(c)), F.lit(""))
        return parse_long(x) if c in _longs(seq) else x

    clean = (
        body.filter(ok)
        .select(F.split(line, DELIMITER, -1).alias("_parts"))
        .select(*[field(c).alias(c) for c in event_columns(seq)])
    )
    rejects = body.filter(~ok).select(line_col)
    return clean, rejects


def parse_lines(lines: DataFrame, seq: str | None = None, line_col: str = LINE,
                header: str | None = None) -> DataFrame:
    return parse_lines_with_rejects(lines, seq, line_col, header)[0]


def read_lines(spark: SparkSession, path: str | list[str], seq: str | None = None) -> DataFrame:
    """Text scan parsed by column expressions (S3 + S4).

    Every file's first line is its header, whose names say where the fields
    are (see ``by_header``); lines equal to it are dropped. A name that a
    header lacks raises.
    """
    parts = [parse_lines(spark.read.text(files), seq, header=header)
             for header, files in by_header(spark, path)]
    return reduce(DataFrame.unionByName, parts or [spark.createDataFrame([], events_schema(seq))])


def load_lines_rdd(sc: SparkContext, path: str | list[str]) -> RDD:
    """RDD facade of S3: 5-string tuples in the canonical order.

    Every file's first line is its header; lines equal to it and lines of
    another arity are dropped. A name that a header lacks raises.
    """
    spark = SparkSession.builder.getOrCreate()

    def tuples(header: str, files: str | list[str]) -> RDD:
        names = header.split(DELIMITER)
        _check_columns(names, None, "the header line")
        at = [names.index(c) for c in EVENT_FIELDS]
        return (
            spark.read.text(files).rdd.map(lambda row: row[0])
            .filter(lambda line: line != header)
            .map(lambda line: line.split(DELIMITER))
            .filter(lambda fields: len(fields) == len(names))
            .map(lambda fields: tuple(fields[i] for i in at))
        )

    parts = [tuples(header, files) for header, files in by_header(spark, path)]
    return sc.union(parts) if parts else sc.emptyRDD()


def write_events_tsv(events: DataFrame, path: str, seq: str | None = None,
                     mode: str = "errorifexists") -> str:
    """Write events as headed tab-separated part files (one header per part)."""
    (
        events.select(*event_columns(seq))
        .write.mode(mode)
        .option("sep", DELIMITER)
        .option("header", "true")
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .csv(path)
    )
    return path
