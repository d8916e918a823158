"""Connected components by alternating large-star and small-star steps.

Each step is a grouped minimum (combined on the map side) and an equi-join on
the same key, so a node with very many links is split by AQE like any skewed
key. The edge table shrinks to one edge (node, smallest node of its component)
in a few rounds; each round is written to the scratch folder, and the one before it deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from voyra.llm.common import discard, scratch, tables_made


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(a, b) links between long ids -> (node, component) for every node that has a
    link to another one; component is the smallest node reachable. Nulls and self
    links are left out; an empty table gives an empty result."""
    e = edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    spark = edges.sparkSession
    with tables_made() as made:
        e = scratch(e, "components")
    before = _signature(e)
    while True:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        # large star: every larger neighbour is linked to the smallest one
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        # small star: the node and its smaller neighbours are linked to the smallest one
        small = (large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low.withColumnRenamed("m", "b")).filter("a != b").distinct())
        old = made
        with tables_made() as made:
            e = scratch(small, "components")
        discard(spark, *old)                 # the round before
        now = _signature(e)
        if now == before:
            return e.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before = now
