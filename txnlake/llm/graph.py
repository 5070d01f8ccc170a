"""Connected components of a large edge table by alternating star steps.

The large-star and small-star steps of Kiveris et al. (2014): each node points
its neighbours to the smallest id it knows. Neighbour lists are never
collected; a step is one grouped minimum joined back to the edges, so a hub
with many links is pre-aggregated and its join partition can be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has
    an edge to another. Edges may repeat, point either way or to themselves;
    an edge with a null end is ignored. No edges: no rows."""
    e = (
        edges.select(F.col(a).alias("a_"), F.col(b).alias("b_"))
        .filter(F.col("a_") != F.col("b_"))
        .select(F.greatest("a_", "b_").alias("u"), F.least("a_", "b_").alias("v"))
        .distinct()
    )
    e = e.checkpoint()
    state = _state(e)
    while True:
        both = e.select(F.col("u").alias("n"), F.col("v").alias("m")).unionByName(
            e.select(F.col("v").alias("n"), F.col("u").alias("m"))
        )
        low = both.groupBy("n").agg(F.least(F.min("m"), F.col("n")).alias("low"))
        large = (
            both.filter(F.col("m") > F.col("n"))
            .join(low, "n")
            .select(F.col("m").alias("u"), F.col("low").alias("v"))
            .filter(F.col("u") != F.col("v"))
            .distinct()
        ).checkpoint()
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        e = (
            large.join(low, "u")
            .select(
                F.explode(
                    F.array(
                        F.struct(F.col("v").alias("u"), F.col("low").alias("v")),
                        F.struct(F.col("u").alias("u"), F.col("low").alias("v")),
                    )
                ).alias("e")
            )
            .select("e.*")
            .filter(F.col("u") != F.col("v"))
            .distinct()
        ).checkpoint()
        now = _state(e)
        if now == state:
            break
        state = now
    stars = e.groupBy("u").agg(F.min("v").alias("component"))
    roots = e.select(F.col("v").alias("node")).distinct()
    return stars.withColumnRenamed("u", "node").unionByName(
        roots.select("node", F.col("node").alias("component"))
    )


def _state(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
