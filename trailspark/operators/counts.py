"""Route frequency and top-n."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import COUNT, ROUTE

DEFAULT_N = 10


def route_counts(routes: DataFrame) -> DataFrame:
    """``route, count``: sessions per whole route (A5); partial then final aggregate."""
    return routes.groupBy(ROUTE).agg(F.count(F.lit(1)).alias(COUNT))


def top_n(counts: DataFrame, n: int = DEFAULT_N) -> DataFrame:
    """The ``n`` most frequent routes; ties at the cut go by route text.

    Sort + limit plans as ``TakeOrderedAndProject``: each task keeps ``n`` rows.
    """
    return counts.orderBy(F.desc(COUNT), F.asc(ROUTE)).limit(n)
