"""Content-based lists from item features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sorrel.functions.lists import encode_scored
from sorrel.operators import similar_lists
from sorrel.operators.clustering import feature_vector, nearest_in_cluster, rejected_features
from sorrel.operators.serving import puts
from sorrel.operators.topk import nearest_to_one
from sorrel.schemas import FEATURES, NEAREST_IN_CLUSTER, OFFLINE_CB, SIMILAR_PER_ITEM
from sorrel.sources import files

ID = "schoolid"


def with_features(items: DataFrame) -> DataFrame:
    return feature_vector(items, FEATURES)


def offline_lists(items: DataFrame, n: int = SIMILAR_PER_ITEM) -> DataFrame:
    """``(base, entries)`` for items with the five feature columns, normalised or raw."""
    return similar_lists.build(with_features(items), ID, "features", n)


def list_puts(lists: DataFrame, written_at: Column | None = None, seq: int = 0) -> DataFrame:
    """Serving-table changes that store the lists, without expiry."""
    stamp = F.current_timestamp() if written_at is None else written_at
    return puts(lists, OFFLINE_CB, F.col("base"), encode_scored(F.col("entries")), stamp, F.lit(seq))


def from_table(spark: SparkSession, table: str, database: str | None = None) -> DataFrame:
    return offline_lists(files.catalogue_table(spark, table, database))


def from_text(spark: SparkSession, path: str) -> DataFrame:
    """Lists of the readable items; see :func:`rejected_items` for the others."""
    return offline_lists(readable(files.items(spark, path)))


def readable(items: DataFrame) -> DataFrame:
    """Items whose line fits the layout and that have an id; the features are judged when they are used."""
    return items.where(F.col(files.CORRUPT).isNull() & F.col(ID).isNotNull())


def rejected_items(items: DataFrame) -> DataFrame:
    """Lines that do not fit the layout, and items without an id or with features that are no numbers."""
    layout = F.col(files.CORRUPT).isNotNull() | F.col(ID).isNull()
    kept_apart = rejected_features(items.where(~layout), FEATURES)
    unread = items.where(layout).withColumn("reject_columns", F.array().cast("array<string>"))
    return unread.unionByName(kept_apart)


def nearest(spark: SparkSession, path: str, query: int, metric: str, n: int = SIMILAR_PER_ITEM) -> DataFrame:
    """The items closest to one item, by ``euclidean`` or ``pearson``."""
    return nearest_to_one(with_features(readable(files.items(spark, path))), query, n, metric, ID, "features")


def nearest_in_own_cluster(spark: SparkSession, path: str, n: int = NEAREST_IN_CLUSTER) -> DataFrame:
    """Closest items within the cluster recorded in the file, with their features and distance."""
    items = with_features(readable(files.items(spark, path, clustered=True)))
    found = nearest_in_cluster(items, ID, "features", "prediction", n)
    described = items.select(F.col(ID).alias("item"), "features")
    return found.join(described, "item").select("prediction", "base", "item", "features", "score", "rank")
