"""Item clusters, chosen by grid search, for a relational table."""

from __future__ import annotations

from pyspark.ml.clustering import KMeansModel
from pyspark.sql import DataFrame

from sorrel.operators import clustering
from sorrel.schemas import FEATURES
from sorrel.sinks.jdbc import appender, cluster_rows


def cluster_items(items: DataFrame, **grid: object) -> tuple[KMeansModel, DataFrame, DataFrame]:
    """Best model, grid metrics, and the items with their ``cluster``."""
    shaped = clustering.feature_vector(items, FEATURES)
    model, metrics = clustering.grid_search(shaped, "features", **grid)
    return model, metrics, clustering.assign(model, shaped, "features")


def store_clusters(assigned: DataFrame, url: str, table: str, **properties: str) -> None:
    appender(cluster_rows(assigned, "schoolid", "schoolname"), url, table, **properties).save()
