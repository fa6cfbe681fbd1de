"""Connected components of a large, sparse set of links, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); root is the smallest
    node that can be reached. Alternates two steps until nothing changes: link
    each larger neighbour to the smallest one, then each smaller one. Every
    step aggregates before it joins, so a node with very many links is one row
    per task in the shuffle, and the result of each step is stored."""
    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    before = None
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # From here on u > v again: a neighbour that is larger than the node.
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        edges = stored(large, "large-star")
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        small = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", F.col("m").alias("v")))
        edges = stored(small.where("u <> v").distinct(), "small-star")
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before or not state[0]:
            break
        before = state
    # Each u now has the one smallest node of its component.
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
