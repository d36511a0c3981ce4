"""K-means clusters and nearest items within them."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from sorrel.functions.similarity import squared_distance
from sorrel.operators.few import best_of_few
from sorrel.operators.topk import top_matches
from sorrel.schemas import KMEANS_ITERATIONS, KMEANS_K, NEAREST_IN_CLUSTER
from sorrel.session import materialise

SEED = 42
GRID_THREADS = 3


def feature_vector(df: DataFrame, columns: Sequence[str], name: str = "features") -> DataFrame:
    """Numeric columns, in order, as one ``array<double>``; null where one of them is no number."""
    whole = F.array(*[F.col(c).try_cast("double") for c in columns])
    return df.withColumn(name, F.when(~F.exists(whole, lambda x: x.isNull()), whole))


def rejected_features(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows without a feature vector, with the names of the columns at fault."""
    faults = F.array(*[F.when(F.col(c).try_cast("double").isNull(), F.lit(c)) for c in columns])
    return df.withColumn("reject_columns", F.array_compact(faults)).where(F.size("reject_columns") > 0)


def _ml(df: DataFrame, vec_col: str) -> DataFrame:
    return df.where(F.col(vec_col).isNotNull()).withColumn("_ml", array_to_vector(F.col(vec_col).cast("array<double>")))


def fit(items: DataFrame, vec_col: str, k: int, iterations: int) -> KMeansModel:
    kmeans = KMeans(featuresCol="_ml", predictionCol="cluster", k=k, maxIter=iterations, seed=SEED)
    return kmeans.fit(_ml(items, vec_col))


def assign(model: KMeansModel, items: DataFrame, vec_col: str) -> DataFrame:
    return model.transform(_ml(items, vec_col)).drop("_ml")


def model_cost(model: KMeansModel, items: DataFrame, vec_col: str) -> float:
    """Sum of squared distances to the final centres; training reports those before its last step."""
    rows = [(i, [float(x) for x in centre]) for i, centre in enumerate(model.clusterCenters())]
    centres = items.sparkSession.createDataFrame(rows, "cluster int, _centre array<double>")
    placed = assign(model, items, vec_col).join(F.broadcast(centres), "cluster")  # one row per cluster
    return placed.agg(F.sum(squared_distance(F.col(vec_col), F.col("_centre")))).head()[0] or 0.0


def grid_search(
    items: DataFrame, vec_col: str, ks: Sequence[int] = KMEANS_K, iterations: Sequence[int] = KMEANS_ITERATIONS
) -> tuple[KMeansModel, DataFrame]:
    """Model of lowest cost, then of fewer clusters, then of fewer iterations; and the metrics."""
    data = items.select(vec_col).persist()
    points = list(product(sorted(ks), sorted(iterations)))

    def run(point: tuple[int, int]) -> tuple[KMeansModel, float]:
        model = fit(data, vec_col, *point)
        return model, model_cost(model, data, vec_col)

    try:
        with ThreadPool(min(GRID_THREADS, len(points))) as pool:
            results = pool.map(run, points)
    finally:
        data.unpersist()
    best = min(range(len(points)), key=lambda i: (results[i][1], i))
    rows = [
        Row(k=p[0], iterations=p[1], cost=float(r[1]), best=i == best) for i, (p, r) in enumerate(zip(points, results))
    ]
    return results[best][0], items.sparkSession.createDataFrame(rows, "k int, iterations int, cost double, best boolean")


def centroids(items: DataFrame, cluster_col: str, vec_col: str) -> DataFrame:
    """Mean vector per cluster; sums of vectors combine before the shuffle."""
    mean = Summarizer.mean(F.col("_ml"))
    means = _ml(items, vec_col).groupBy(cluster_col).agg(mean.alias("_mean"))
    return means.select(cluster_col, vector_to_array("_mean").alias("centroid"))


def nearest_centroid(items: DataFrame, id_col: str, vec_col: str, centres: DataFrame, cluster_col: str) -> DataFrame:
    """``(id, cluster, distance)`` with the closest centroid, the lower cluster number on ties."""
    centres = materialise(centres.select(F.col(cluster_col).alias(id_col), F.col("centroid").alias(vec_col)))
    found = best_of_few(items, centres, 1, "euclidean", id_col, vec_col, exclude_self=False)
    return found.select(F.col("base").alias(id_col), F.col("item").alias("cluster"), F.col("score").alias("distance"))


def within_cost(assigned: DataFrame) -> DataFrame:
    """Sum of squared distances to the assigned centroids."""
    return assigned.agg(F.sum(F.col("distance") * F.col("distance")).alias("wssse"))


def cluster_sizes(assigned: DataFrame, cluster_col: str = "cluster") -> DataFrame:
    return assigned.groupBy(F.col(cluster_col).alias("cluster")).agg(F.count(F.lit(1)).alias("n_items"))


def nearest_in_cluster(
    items: DataFrame, id_col: str, vec_col: str, cluster_col: str, n: int = NEAREST_IN_CLUSTER
) -> DataFrame:
    """The ``n`` closest other members of the own cluster, for every item."""
    return top_matches(items, None, n, "euclidean", id_col, vec_col, group_col=cluster_col)
