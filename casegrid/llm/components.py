"""Connected components of a graph that is too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casegrid.session import materialise


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")),
                           F.sum(F.xxhash64("b", "a") % 1000003)).first())


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``; the component
    is the smallest node that can be reached.

    Alternates the large-star and small-star steps of Kiveris et al. (2014):
    every step links nodes to the smallest neighbour, so the edges turn into
    one star per component.  A node's minimum is a map-side combined aggregate
    and is joined back to its edges, so no task ever holds the neighbours of a
    node.  Each round is written to the shared checkpoint folder; the driver
    sees three numbers per round.

    Empty input gives an empty result; self-loops give no row.
    """
    cur = materialise(
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = _signature(cur)
    while True:
        both = cur.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            cur.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.min("u")).alias("m"))
        large = (both.where(F.col("v") > F.col("u")).join(low, "u")
                 .select(F.col("v").alias("a"), F.col("m").alias("b")).distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").where(F.col("b") != F.col("m"))
                 .select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low.select("a", F.col("m").alias("b"))))
        cur = materialise(small.distinct(), "edges")
        now = _signature(cur)
        if now == before:
            break
        before = now
    return cur.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        cur.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
