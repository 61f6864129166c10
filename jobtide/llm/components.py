"""Connected components of a stored edge table, by alternating star contractions.

Every vertex ends up linked to the smallest vertex it can reach. Large-star links the
larger neighbours of a vertex to its least neighbour, small-star the smaller ones; each
round is two shuffles of the edge table, and about the square logarithm of the longest
chain rounds are needed. Edges are written after each round, so a lost executor costs one
round at most, and nothing is held in the driver.

Neighbour lists are never gathered: each star is an aggregate (the least neighbour) and a
join back on the vertex, which adaptive execution splits for a vertex with many edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.llm.frames import stored


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """One contraction; rows (a, b) with a > b."""
    seen = edges if small else _both_ways(edges)
    least = seen.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("m"))
    # Written, so that both sides of the join are shuffled and a hot vertex can be split.
    least = stored(least.withColumn("m", F.least("m", "v")), "least-neighbours")
    moved = seen.join(least, seen["a"] == least["v"]).select(F.col("b").alias("a"), F.col("m").alias("b"))
    if small:
        links = moved.union(least.select(F.col("v").alias("a"), F.col("m").alias("b")))
        return links.where("a > b").distinct()
    return moved.where("a > b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(vertex, root) for each vertex of `edges` (a, b); root is the least vertex it can reach.

    Loops and null ends are left out; repeated and reversed edges do no harm. Vertices
    without an edge are not listed. An empty table gives no rows.
    """
    plain = edges.where("a is not null and b is not null and a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    now = stored(plain.distinct(), "links")
    before = None
    while True:
        now = stored(_star(now, small=False), "large-star")
        now = stored(_star(now, small=True), "small-star")
        # Both stars leave a forest of stars as it is.
        mark = tuple(
            now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        )
        if mark == before:
            break
        before = mark
    roots = now.select(F.col("b").alias("vertex"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("vertex"), F.col("b").alias("root")).union(roots)
