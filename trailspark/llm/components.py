"""Connected components of a graph given as pairs, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settled


def _digest(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(u, v)``; root is the component's least node.

    Large stars hang a node's greater neighbours on its least neighbour, small
    stars its lesser ones; repeated in turn they flatten every component into
    one star after logarithmically many rounds. A hub's neighbours are never
    collected: its least neighbour is an aggregate, joined back to the edges,
    and each round is written to the shared folder.
    """
    e = settled(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                .where("u <> v").distinct())
    before = _digest(e)
    while before[0]:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = settled(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = (both.where("v > u").join(least, "u").where("v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        large = settled(large)
        least = settled(large.groupBy("u").agg(F.min("v").alias("m")))
        small = (large.join(least, "u").where("v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))))
        e = settled(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                    .distinct())
        after = _digest(e)
        if after == before:
            break
        before = after
    roots = e.select(F.col("v").alias("node")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        roots.select("node", F.col("node").alias("root")))
