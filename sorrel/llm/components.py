"""Connected components by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sorrel.llm.common import stored

#: Tasks over which the neighbours of one node are spread.
SALTS = 16


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest one.

    The minima combine before their shuffle. A hub's neighbours meet its minimum in several tasks.
    """
    near = _both_ways(edges)
    least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    copies = least.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    larger = near.where("b > a").withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALTS)).cast("int"))
    return larger.join(copies, ["a", "salt"]).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of these, in several tasks for a hub."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    copies = least.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = down.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALTS)).cast("int"))
    moved = salted.join(copies, ["a", "salt"]).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` of every node of an edge, the component being its smallest node.

    ``edges`` has columns ``a`` and ``b`` of one ordered kind, longs or digests. The two steps keep the edges few, need a
    number of rounds that is logarithmic in the length of chains, and each round is stored.
    """
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        now = stored(_small_star(_large_star(now)).where("a <> b").distinct())
        state = now.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first()
        if state == before:
            break
        before = state
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
