"""Recommendations for the users of one batch of scored behaviours."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sorrel.operators.joins import lookup_join
from sorrel.operators.ranking import rank_within


def content_candidates(scores: DataFrame, lists: DataFrame) -> DataFrame:
    """``(user_id, item, weight)`` from the similar items of all that a user touched.

    The weight is similarity times score; of several routes to an item the heaviest
    counts. ``lists`` is ``(base, entries)`` and items without a list add nothing.
    """
    keyed = scores.select("user_id", F.col("item_id").cast("bigint").alias("base"), "score")
    offered = lookup_join(keyed, lists.select("base", "entries"), ["base"], ["user_id"])
    return (
        offered.select("user_id", "score", F.explode_outer("entries").alias("_e"))
        .where(F.col("_e").isNotNull())
        .select("user_id", F.col("_e.item").alias("item"), (F.col("_e.sim") * F.col("score")).alias("weight"))
        .groupBy("user_id", "item")
        .agg(F.max("weight").alias("weight"))
    )


def content_recommendations(scores: DataFrame, lists: DataFrame, limit: int | None = None) -> DataFrame:
    """Candidates ranked per user, heaviest first; all of them unless ``limit`` is given."""
    candidates = content_candidates(scores, lists)
    order = [F.round("weight", 10).desc(), F.col("item").asc()]
    if limit is None:
        return rank_within(candidates, "user_id", order)
    window = Window.partitionBy("user_id").orderBy(*order)
    return candidates.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= limit)


def prepared_recommendations(scores: DataFrame, lists: DataFrame, default: str | None = None) -> DataFrame:
    """The prepared list of each active user; ``default`` for users without one, or no row."""
    users = scores.select(F.col("user_id").cast("string").alias("key")).distinct()
    stored = lists.where(F.trim("value") != "").select("key", "page", "value")
    found = users.join(stored, "key", "left").select(
        "key",
        F.coalesce("page", F.lit(0).cast("bigint")).alias("page"),
        F.coalesce("value", F.lit(default).cast("string")).alias("value"),
    )
    return found.where(F.col("value").isNotNull())
