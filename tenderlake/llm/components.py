"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderlake.llm.common import stored


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of an edge; component is the smallest node reached.

    Each round ties the larger neighbours of a node to the smallest node around
    it (large star), then the smaller ones (small star). Rounds grow with the
    logarithm of the longest chain. Neighbourhood minima are partial
    aggregates, and both sides of each join are stored tables, so a node with
    very many edges is split by the skew join. Loops and edges with a null end
    are left out.
    """
    now = stored(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                 .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct(), "edges")
    while not _is_star(now):
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _pull(both, F.col("v") > F.col("u"))
        now = stored(large.distinct(), "large")
        # A node and its smaller neighbours are all tied to the smallest of them.
        small = _pull(now, F.lit(True)).where("u <> v").unionAll(_minima(now))
        now = stored(small.distinct(), "small")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _minima(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.min("v").alias("v"))


def _pull(pairs: DataFrame, which) -> DataFrame:
    """For each neighbour chosen by ``which``: (neighbour, smallest node of the neighbourhood)."""
    least = stored(_minima(pairs).select("u", F.least("u", "v").alias("m")), "least")
    return pairs.where(which).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _is_star(pairs: DataFrame) -> bool:
    """Every left node has one right node, and no right node is a left node."""
    ends = pairs.select(F.col("u").alias("node"), F.lit(1).alias("left"), F.lit(0).alias("right")).unionAll(
        pairs.select(F.col("v").alias("node"), F.lit(0).alias("left"), F.lit(1).alias("right")))
    return ends.groupBy("node").agg(F.sum("left").alias("left"), F.max("right").alias("right")).where(
        "left > 1 OR left = 1 AND right = 1").isEmpty()
