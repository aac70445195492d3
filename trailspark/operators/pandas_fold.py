"""Vectorized fold over sorted event batches (``mapInPandas``).

Spark does the distribution: distinct events are shuffled and sorted by
``(user_id, session_id, bucket, order...)``; each task walks its Arrow batches
with numpy. Batches are re-cut so that a bucket never straddles two chunks;
what is held back is at most one session's distinct events of one bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..schema import BUCKET_SECONDS, PAGE, SESSION, TS, USER, order_columns
from .buckets import BUCKET, BUCKET_KEY, CUT, ERR, PAGES, distinct_events, slim_events, stitch

NO_ERROR = np.iinfo(np.int64).max

FRAGMENT_SCHEMA = T.StructType(
    [
        T.StructField(USER, T.LongType()),
        T.StructField(SESSION, T.LongType()),
        T.StructField(BUCKET, T.LongType()),
        T.StructField(CUT, T.LongType()),
        T.StructField(PAGES, T.ArrayType(T.StringType())),
    ]
)


def _starts(pdf: pd.DataFrame) -> np.ndarray:
    """Mask of the rows that begin a bucket of a session."""
    start = np.ones(len(pdf), dtype=bool)
    start[1:] = False
    for c in BUCKET_KEY:
        v = pdf[c].to_numpy(np.int64)
        start[1:] |= v[1:] != v[:-1]
    return start


def whole_buckets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Regroup key-sorted batches so that each frame holds only whole buckets."""
    held: list[pd.DataFrame] = []
    for pdf in batches:
        if pdf.empty:
            continue
        joined = pd.concat([held[-1].iloc[-1:], pdf], ignore_index=True) if held else pdf
        inner = np.flatnonzero(_starts(joined)[1:]) + 1 - (1 if held else 0)
        if inner.size == 0:
            held.append(pdf)
            continue
        cut = int(inner[-1])
        head = [*held, pdf.iloc[:cut]]
        yield pd.concat(head, ignore_index=True)
        held = [pdf.iloc[cut:]]
    if held:
        yield pd.concat(held, ignore_index=True)


def fold_buckets(pdf: pd.DataFrame) -> pd.DataFrame:
    """Fragments of whole, sorted buckets: cut at the first error time, collapse."""
    start = _starts(pdf)
    first = np.flatnonzero(start)
    at = np.cumsum(start) - 1
    ts, err = pdf[TS].to_numpy(np.int64), pdf[ERR].to_numpy(bool)
    pages = pdf[PAGE].to_numpy(object)
    cut = np.full(first.size, NO_ERROR, dtype=np.int64)
    np.minimum.at(cut, at[err], ts[err])
    change = start.copy()
    change[1:] |= pages[1:] != pages[:-1]
    kept = np.flatnonzero(change & (ts < cut[at]))
    bounds = np.searchsorted(at[kept], np.arange(first.size + 1))
    return pd.DataFrame({
        **{c: pdf[c].to_numpy(np.int64)[first] for c in BUCKET_KEY},
        CUT: pd.Series(cut).astype("Int64").mask(cut == NO_ERROR),
        PAGES: [list(pages[kept[a:b]]) for a, b in zip(bounds, bounds[1:], strict=False)],
    })


def _fold_partition(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for chunk in whole_buckets(batches):
        yield fold_buckets(chunk)


def routes_pandas(events: DataFrame, seq: str | None = None,
                  width: int = BUCKET_SECONDS) -> DataFrame:
    """U1 as a vectorized fold: cluster by bucket, sort, ``mapInPandas``, stitch."""
    rows = distinct_events(slim_events(events, seq, width))
    ordered = rows.repartition(*BUCKET_KEY).sortWithinPartitions(
        *BUCKET_KEY, *order_columns(seq))
    return stitch(ordered.mapInPandas(_fold_partition, FRAGMENT_SCHEMA))
