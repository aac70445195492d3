"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trailspark.runtime import ensure_checkpoint_dir

# Tables of at most this many rows and bytes may be broadcast; both are counted
# first, and beyond either the join is left to the planner.
MAX_BROADCAST_ROWS, MAX_BROADCAST_BYTES = 50_000, 16 << 20
# Equal rows that one task makes of their count.
COPIES = 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read whole."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pack(df: DataFrame, **cols: str) -> DataFrame:
    """``row`` (the whole input row as a struct) plus the named columns.

    Helper columns then live beside ``row`` and can never clash with columns
    of the input; ``unpack`` gives the input columns back.
    """
    row = F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("row")
    return df.select(row, *[df[f"`{c}`"].alias(name) for name, c in cols.items()])


def unpack(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """The input columns of a packed frame, in their order."""
    return df.select(*[F.col("row").getField(c).alias(c) for c in columns])


def settled(df: DataFrame) -> DataFrame:
    """``df`` written once to the cluster's shared checkpoint folder, lineage cut.

    The rows are cached while they are written, as the reliable checkpoint
    would otherwise run the plan a second time.
    """
    ensure_checkpoint_dir(df.sparkSession)
    cached = df.persist()
    try:
        return cached.checkpoint(eager=True)
    finally:
        cached.unpersist()


def small(df: DataFrame) -> DataFrame:
    """Broadcast hint, only if rows and bytes, both counted, prove that ``df`` is small."""
    size = df.limit(MAX_BROADCAST_ROWS + 1).agg(
        F.count("*").alias("rows"), F.sum(F.length(F.to_json(F.struct("*")))).alias("bytes")).first()
    few = size["rows"] <= MAX_BROADCAST_ROWS and (size["bytes"] or 0) <= MAX_BROADCAST_BYTES
    return F.broadcast(df) if few else df


def numbered(counted: DataFrame, *key: str, copies: int | None = None) -> DataFrame:
    """A row with ``copy`` from 1 to ``n`` for each row of ``counted``; many copies are spread
    over tasks by ``key``."""
    copies = copies or COPIES
    n, block = F.col("n"), F.col("block")
    rest = [c for c in counted.columns if c != "n"]
    own = [F.col(c).alias(c) for c in (*rest, "copy")]  # of its own for either part of the union
    few = counted.where(n <= copies).select(
        *rest, F.explode(F.sequence(F.lit(1).cast("long"), n)).alias("copy"))
    many = (
        counted.where(n > copies)
        .select(*rest, "n", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / copies)))
                .alias("block"))
        .repartition(*key, "block")
        .select(*rest, F.explode(F.sequence(block * copies + 1, F.least(n, (block + 1) * copies)))
                .alias("copy"))
    )
    return few.select(*own).unionByName(many.select(*own))


def fenced(df: DataFrame, keep: Iterable[str], computed: Iterable[str]) -> DataFrame:
    """``df`` with its costly ``computed`` columns passed through a one-row generator.

    The optimizer copies a column's expression into every filter on it; a
    generator's output is computed once and only read by what follows.
    """
    return df.select(*keep, F.inline(F.array(F.struct(*computed))))


def key_part(c: str | Column) -> Column:
    """A grouping key that never is null: ``=value``, or ``?`` for null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("?"))


def spaced(text: Column) -> Column:
    """``text`` ("" if null) with tab, LF, VT, FF and CR turned into spaces."""
    out = F.coalesce(text, F.lit(""))
    for c in "\t\n\x0b\x0c\r":
        out = F.replace(out, F.lit(c), F.lit(" "))
    return out


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the whole text, in order."""
    return F.array_remove(F.split(spaced(text), " "), "")


def map_rows(df: DataFrame, fn: Callable[[dict[str, list]], dict[str, list]], schema: str,
             rows: int = 256) -> DataFrame:
    """``mapInArrow`` over slices of at most ``rows`` rows, as columns of Python values."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    out = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                got = fn(batch.slice(at, rows).to_pydict())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(got[f.name], f.type) for f in out], schema=out)

    return df.mapInArrow(run, schema)
