"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesengine.scratch import materialize

# Rounds after which something must be wrong: they are logarithmic in the longest chain.
MAX_ROUNDS = 60


def _least(sides: DataFrame) -> DataFrame:
    """Each ``(u, v)`` with ``m``, the smallest of ``u`` and its partners."""
    smallest = sides.groupBy("u").agg(F.min("v").alias("low"))
    return sides.join(smallest, "u").select("u", "v", F.least("u", "low").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Partners above a node are linked to the smallest in its neighbourhood."""
    sides = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    return _least(sides).filter("v > u").select(F.col("m").alias("a"), F.col("v").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its partners below it are linked to the smallest of them."""
    sides = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = _least(sides)
    own = least.select(F.col("m").alias("a"), F.col("u").alias("b"))
    below = least.filter("v <> m").select(F.col("m").alias("a"), F.col("v").alias("b"))
    return own.unionByName(below).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` of every node in ``edges`` (``a, b``: long, not null).

    The component is the smallest node that can be reached. Edges may repeat, point
    either way or join a node to itself. Each round is written and read again, so the
    plan does not grow. The rounds end when the written edges do not change any more.
    """
    metrics = {
        "rows": F.count("*"),
        "mark": F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
    }
    stars, seen = materialize(
        edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        "edges",
        **metrics,
    )
    for _ in range(MAX_ROUNDS):
        before = seen
        if not before["rows"]:
            break
        stars, seen = materialize(_small_star(_large_star(stars)), "stars", **metrics)
        if seen == before:
            break
    else:
        raise RuntimeError("components did not settle")
    return stars.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(
        stars.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    )
