"""Behaviours to scored ratings, factor models and stored recommendations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sorrel.operators import als, behaviour
from sorrel.operators.serving import paged_ids, puts
from sorrel.schemas import OFFLINE_ALS, UNSEEN_PER_USER
from sorrel.session import materialise
from sorrel.sources import files


def ratings_from_behaviours(spark: SparkSession, path: str) -> DataFrame:
    return behaviour.score(behaviour.accepted(files.behaviours(spark, path)))


def ratings_from_indexed(spark: SparkSession, path: str) -> DataFrame:
    parsed = behaviour.parse_indexed_ratings(spark.read.text(path))
    return behaviour.accepted_ratings(parsed).select("user_id", "item_id", "score")


def indexed_ratings(ratings: DataFrame) -> DataFrame:
    """Ratings with their number in (user, item) order, as dumped for inspection."""
    return behaviour.rating_index(ratings)


def train_and_recommend(
    ratings: DataFrame, catalogue: DataFrame, n: int = UNSEEN_PER_USER, **grid: object
) -> tuple[als.FactorModel, DataFrame, DataFrame]:
    """Best model of the grid, its metrics, and the best unseen items per user."""
    ratings = materialise(ratings)
    model, metrics = als.grid_search(ratings, **grid)
    return model, metrics, als.top_unseen(model.users, model.items, ratings, catalogue, n)


def recommendation_puts(recommended: DataFrame, written_at: Column | None = None, seq: int = 0) -> DataFrame:
    """Serving-table changes with the item ids of each user, without expiry."""
    stamp = F.current_timestamp() if written_at is None else written_at
    keyed = recommended.withColumn("key", F.col("user_id").cast("string"))
    pages = paged_ids(keyed, "key", "item_id", "rank")
    return puts(pages, OFFLINE_ALS, F.col("key"), F.col("value"), stamp, F.lit(seq), page=F.col("page"))
