"""Matrix factorisation: training, grid search and recommendations."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from sorrel.functions.similarity import dot
from sorrel.operators.behaviour import rmse, split_bucket, split_name
from sorrel.operators.joins import lookup_join
from sorrel.operators.ranking import global_index
from sorrel.operators.few import best_for_few
from sorrel.operators.pruned import top_matches_pruned
from sorrel.operators.topk import top_matches
from sorrel.schemas import ALS_ITERATIONS, ALS_LAMBDAS, ALS_RANKS, UNSEEN_PER_USER
from sorrel.session import ensure_checkpoint_dir, materialise

SEED = 42
GRID_THREADS = 4


@dataclass
class FactorModel:
    """Factors by the caller's own ids, which may be any 64-bit numbers, and the fitted model."""

    model: ALSModel
    users: DataFrame
    items: DataFrame

    @property
    def rank(self) -> int:
        return self.model.rank


def _indexed(ratings: DataFrame, column: str, name: str) -> DataFrame:
    """Dense numbers for the ids of a column; the trainer takes 32-bit ones only."""
    ids = ratings.select(column).where(F.col(column).isNotNull()).distinct()
    return materialise(global_index(ids, [F.col(column)], name).withColumn(name, F.col(name).cast("int")))


def fit(ratings: DataFrame, rank: int = 10, iterations: int = 10, reg: float = 0.6) -> FactorModel:
    """Explicit-feedback ALS; checkpoints keep the lineage of the factors short."""
    ensure_checkpoint_dir(ratings.sparkSession)
    users, items = _indexed(ratings, "user_id", "_user"), _indexed(ratings, "item_id", "_item")
    rated = ratings.where("user_id is not null and item_id is not null and score is not null")
    known = lookup_join(lookup_join(rated, users, ["user_id"], ["item_id"]), items, ["item_id"], ["user_id"])
    als = ALS(
        userCol="_user", itemCol="_item", ratingCol="score", rank=rank, maxIter=iterations,
        regParam=reg, seed=SEED, coldStartStrategy="drop", checkpointInterval=5,
    )
    model = als.fit(known.select("_user", "_item", F.col("score").cast("float").alias("score")))

    def named_factors(factors: DataFrame, index: DataFrame, number: str, column: str) -> DataFrame:
        features = F.col("features").cast("array<double>").alias("features")
        return index.join(factors.withColumnRenamed("id", number), number).select(
            F.col(column).cast("bigint").alias("id"), features
        )

    return FactorModel(
        model, named_factors(model.userFactors, users, "_user", "user_id"),
        named_factors(model.itemFactors, items, "_item", "item_id"),
    )


def model_rmse(model: FactorModel, ratings: DataFrame) -> float | None:
    """RMSE over the pairs that the model knows."""
    predicted = predict(model.users, model.items, ratings)
    return rmse(predicted, "prediction", "score").head()[0]


def fixed_split(ratings: DataFrame) -> DataFrame:
    return split_bucket(ratings).withColumn("part", split_name(F.col("bucket")))


def grid_search(
    ratings: DataFrame,
    ranks: Sequence[int] = ALS_RANKS,
    iterations: Sequence[int] = ALS_ITERATIONS,
    lambdas: Sequence[float] = ALS_LAMBDAS,
) -> tuple[FactorModel, DataFrame]:
    """Best model by validation RMSE, the first one on ties, and a metrics frame.

    The frame has one row per grid point; the test RMSE is filled for the best.
    """
    spark = ratings.sparkSession
    parts = fixed_split(ratings).persist()
    train, validation, test = (parts.where(F.col("part") == p) for p in ("train", "validation", "test"))
    points = list(product(ranks, iterations, lambdas))

    def run(point: tuple[int, int, float]) -> tuple[FactorModel, float]:
        model = fit(train, *point)
        error = model_rmse(model, validation)
        return model, float("inf") if error is None else error

    try:
        with ThreadPool(min(GRID_THREADS, len(points))) as pool:
            results = pool.map(run, points)
        best = min(range(len(points)), key=lambda i: (results[i][1], i))
        test_rmse = model_rmse(results[best][0], test)
    finally:
        parts.unpersist()
    rows = [
        Row(rank=p[0], iterations=p[1], reg=float(p[2]), validation_rmse=float(r[1]), best=i == best,
            test_rmse=test_rmse if i == best else None)
        for i, (p, r) in enumerate(zip(points, results))
    ]
    schema = "rank int, iterations int, reg double, validation_rmse double, best boolean, test_rmse double"
    return results[best][0], spark.createDataFrame(rows, schema)


def factors(model: FactorModel) -> DataFrame:
    """User and item factors in one frame, ``kind`` telling them apart."""
    users = model.users.select(F.lit("user").alias("kind"), "id", "features")
    return users.unionByName(model.items.select(F.lit("item").alias("kind"), "id", "features"))


# The recommenders below work on factor frames ``(id, features)``, wherever these come from.


def predict(users: DataFrame, items: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs with their ``prediction``; pairs with an unknown user or item are dropped."""
    user = users.select(F.col("id").alias("user_id"), F.col("features").alias("_user"))
    item = items.select(F.col("id").alias("item_id"), F.col("features").alias("_item"))
    met = lookup_join(lookup_join(pairs, user, ["user_id"], ["item_id"]), item, ["item_id"], ["user_id"])
    return met.withColumn("prediction", dot(F.col("_user"), F.col("_item"))).drop("_user", "_item")


def top_unseen(
    users: DataFrame, items: DataFrame, seen: DataFrame, catalogue: DataFrame, n: int = UNSEEN_PER_USER,
    **bounds: object,
) -> DataFrame:
    """Best ``n`` catalogue items per user of ``seen`` that the user has not rated.

    Seen pairs are masked where a block of users meets a block of items, so a user
    with a long history costs no longer candidate lists. ``bounds`` (``block_rows``, ``worth``,
    ``report``) asks for items in blocks by norm, with a user's n-th best so far as threshold from block to block.
    """
    pairs = materialise(seen.select(F.col("user_id").alias("base"), F.col("item_id").alias("item")).distinct())
    active = users.join(pairs.select(F.col("base").alias("id")).distinct(), "id", "left_semi")
    offered = items.join(catalogue.select(F.col("item_id").alias("id")).distinct(), "id", "left_semi")
    given = ("dot", "id", "features")
    match = top_matches_pruned if bounds else top_matches
    best = match(active, offered, n, *given, exclude_self=False, exclude=pairs, **bounds)
    return _recommended(best, "user_id", "item_id")


def _recommended(best: DataFrame, base: str, other: str) -> DataFrame:
    return best.select(F.col("base").alias(base), F.col("item").alias(other), F.col("score").alias("rating"), "rank")


def _chosen(factors: DataFrame, ids: DataFrame | None, column: str) -> DataFrame:
    return factors if ids is None else factors.join(ids.select(F.col(column).alias("id")).distinct(), "id", "left_semi")


def _best_products(base: DataFrame, only: DataFrame | None, column: str, others: DataFrame, n: int) -> DataFrame:
    """Best products for all of ``base`` or, where those of ``only`` are few, without a shuffle of the others."""
    chosen = _chosen(base, only, column)
    if only is None:
        return top_matches(chosen, others, n, "dot", "id", "features", exclude_self=False)
    return best_for_few(chosen, others, n, "dot", "id", "features", exclude_self=False)


def items_for_users(users: DataFrame, items: DataFrame, n: int, only: DataFrame | None = None) -> DataFrame:
    """Best ``n`` items, rated or not, for all users or for those of ``only``."""
    return _recommended(_best_products(users, only, "user_id", items, n), "user_id", "item_id")


def users_for_items(users: DataFrame, items: DataFrame, n: int, only: DataFrame | None = None) -> DataFrame:
    """Best ``n`` users for all items or for those of ``only``."""
    return _recommended(_best_products(items, only, "item_id", users, n), "item_id", "user_id")


def named(recommendations: DataFrame, names: DataFrame, digits: int | None = None) -> DataFrame:
    """Adds the item name and the ``name,rating`` label; ``digits`` fixes the decimals of the rating."""
    joined = lookup_join(recommendations, names.select("item_id", "name"), ["item_id"], ["user_id"])
    rating = F.col("rating").cast("string") if digits is None else F.format_string(f"%.{digits}f", "rating")
    return joined.withColumn("label", F.concat_ws(",", "name", rating))


def similar_items(items: DataFrame, n: int) -> DataFrame:
    """Best ``n`` other items per item by cosine of their factors."""
    return top_matches(items, None, n, "cosine", "id", "features")
