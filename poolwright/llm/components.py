"""Connected components of a table of links, by Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poolwright.session import materialize


def components(links: DataFrame) -> DataFrame:
    """Smallest node reachable from each node of ``links`` (columns ``a``, ``b``): rows (node, root).

    Alternates two steps until nothing changes: every node joins its larger
    neighbours, or its smaller ones, to the smallest node among its neighbours and
    itself. Long chains shrink by halves; a node with very many neighbours only
    takes part in aggregations and in joins that Spark can split.
    """
    both = links.filter("a is not null and b is not null and a <> b")
    edges = materialize(both.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while True:
        # every node: its smallest neighbour or itself
        pairs = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = pairs.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = pairs.filter("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = materialize(large.filter("a <> b"), "links")
        # small step: smaller neighbours and the node itself go to the smallest neighbour
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(smallest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        new = materialize(small.union(smallest.select("a", F.col("m").alias("b"))).distinct(), "links")
        if new.exceptAll(edges).isEmpty() and edges.exceptAll(new).isEmpty():
            break
        edges = new
    roots = edges.groupBy("a").agg(F.min("b").alias("root"))
    return roots.select(F.col("a").alias("node"), "root").union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
