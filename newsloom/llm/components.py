"""Connected components of a link table, as joins and aggregates over staged tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.sources.writers import stage

MAX_ROUNDS = 50


def connected(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links(a, b)``; root is the smallest node reachable.

    Two kinds of rounds alternate: every node hands its larger neighbours to the
    smallest node it knows, then every node hands its smaller ones. Each is an
    aggregate with partial sums on the map side and a join that Spark may split
    where a node has very many links. The tables shrink to one link per node.
    """
    edges = stage(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = None
    for _ in range(MAX_ROUNDS):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b").distinct()
        large = stage(large, "links")
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select(F.when(F.col("b") == F.col("low"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("low").alias("b"))
        edges = stage(small.where("a <> b").distinct(), "links")
        before, state = state, edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
    else:
        raise RuntimeError(f"links did not settle in {MAX_ROUNDS} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
