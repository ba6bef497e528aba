"""Connected components of a graph of longs, by rounds of joins on stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatgrid.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every end of an edge ``(a, b)``; ``root`` is the smallest (signed) node it can reach.

    Alternates two steps until nothing changes: every node links its larger neighbours to its smallest one, then
    every node links all its smaller neighbours to the smallest. Both keep components as they are and turn them
    into stars in a number of rounds that grows with the logarithm of their size. The smallest neighbour is found by
    partial aggregation and joined back, so a node with very many links is not gathered anywhere.
    """

    def star(links: DataFrame, larger: bool) -> DataFrame:
        both = links.union(links.select("b", "a")) if larger else links.select(F.greatest("a", "b"), F.least("a", "b")).toDF("a", "b")
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        joined = both.join(least, "a")
        moved = joined.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")) if larger else (
            joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        )
        return moved.filter("a <> b").distinct()

    def state(links: DataFrame) -> tuple:
        return tuple(links.agg(
            F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.shiftright(F.xxhash64("b", "a"), 20))
        ).first())

    links = stored(edges.select(F.col("a").cast("long"), F.col("b").cast("long")).filter("a <> b").distinct(), "links")
    before = None
    while (now := state(links)) != before and now[0]:
        before = now
        links = stored(star(stored(star(links, True), "links-large"), False), "links-small")
    nodes = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stored(nodes.union(links.select("b", "b")).distinct(), "components")
