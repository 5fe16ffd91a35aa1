"""Connected components of an edge table, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagedater.session import stage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Point the larger (or smaller and own) neighbours of each node at its smallest one."""
    both = edges if not large else edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # Small star: edges already run from the larger node to the smaller.
    least = both.groupBy("a").agg(F.min("b").alias("_low"))
    joined = both.join(least, "a").withColumn("_low", F.least("_low", "a"))
    if large:
        out = joined.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("_low").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("_low").alias("b")).unionByName(
            joined.select("a", F.col("_low").alias("b"))
        )
    return out.filter(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for all nodes of ``edges`` (a long, b long), root the smallest reachable.

    Alternates large and small stars, each pair of rounds written to the shared folder,
    until a pair changes nothing; the rounds grow with the logarithm of a component, and a
    hot node costs a partial minimum and a join that splits skewed keys, never a list.
    """
    current = stage(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .filter(F.col("a") != F.col("b"))
        .distinct(),
        "edges",
    )
    before = None
    while True:
        # Both stars keep the components; equal sums of hashes mean equal edge sets.
        mark = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(mark) == before:
            break
        before = tuple(mark)
        current = stage(_star(_star(current, True), False), "edges")
    nodes = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.unionByName(current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
