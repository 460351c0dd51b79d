"""Connected components of a graph given as links between numbers.

Large-star and small-star steps alternate: each joins a node's neighbours to the smallest node
next to it, first the larger neighbours, then the others, until nothing changes. A step moves
links only; the smallest neighbour comes from an aggregation that combines before it shuffles, and
joins it back, so that a node with many links is split like any skewed join. Every step's links
are written to the shared folder, so a lost executor costs one step; as files in proportion to the
links, not one for each partition of a shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.cluster import files_for, written


def _stars(links: DataFrame, both_ways: bool) -> DataFrame:
    """Each node's neighbours ``v`` with ``m``, the smallest of the node and its neighbours."""
    if both_ways:
        links = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select(F.col("u").alias("w"), F.least("m", "u").alias("m"))
    return links.join(least, links.u == least.w).select("u", "v", "m")


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component`` (its smallest node) for every node that has a link.

    Links of a node to itself, null ends and repeated links change nothing."""
    spark = links.sparkSession
    low, high = F.least(a, b), F.greatest(a, b)
    edges = written(
        links.where(f"{a} is not null and {b} is not null")
        .select(high.alias("u"), low.alias("v")).where("u > v").distinct(),
        "links", files_for(spark, links.count()),
    )
    n, before = edges.count(), None
    while True:
        large = _stars(edges, both_ways=True).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = _stars(large.where("u > v").distinct(), both_ways=False)
        moved = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            small.select("u", F.col("m").alias("v"))
        )
        # A link is read both ways and moves to two links at most.
        edges = written(moved.where("u > v").distinct(), "links", files_for(spark, 4 * n))
        # The same links again: every node hangs on the smallest of its component.
        state = edges.select(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.sum(F.col("v").cast("decimal(38,0)"))
        ).first()
        if state == before:
            break
        n, before = state[0], state
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
