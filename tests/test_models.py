import math

import numpy as np
import pytest
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import functions as F

from sorrel.operators import als, clustering
from sorrel.operators.behaviour import score
from checks import inputs


@pytest.fixture(scope="module")
def ratings(spark, folder):
    return score(inputs.behaviours(spark, folder)).persist()


@pytest.fixture(scope="module")
def model(ratings):
    return als.fit(ratings, 5, 5, 0.1)


def factor_arrays(model):
    users = {r["id"]: np.array(r["features"]) for r in model.users.collect()}
    items = {r["id"]: np.array(r["features"]) for r in model.items.collect()}
    return users, items


def test_factors_and_predictions(spark, model, ratings):
    users, items = factor_arrays(model)
    assert als.factors(model).count() == len(users) + len(items)
    pairs = spark.createDataFrame([(0, 0), (0, 10_000), (10_000, 0)], "user_id int, item_id int")
    rows = als.predict(model.users, model.items, pairs).collect()
    assert [(r["user_id"], r["item_id"]) for r in rows] == [(0, 0)]
    assert rows[0]["prediction"] == pytest.approx(users[0] @ items[0], abs=1e-4)


def test_top_unseen_is_exact(model, ratings):
    users, items = factor_arrays(model)
    seen = {(r["user_id"], r["item_id"]) for r in ratings.collect()}
    catalogue = ratings.select("item_id").distinct().where("item_id <> 3")
    got = {}
    for r in als.top_unseen(model.users, model.items, ratings, catalogue, 7).collect():
        got.setdefault(r["user_id"], {})[r["rank"]] = r["item_id"]
    for user, vec in users.items():
        free = [(-round(float(vec @ v), 10), i) for i, v in items.items() if (user, i) not in seen and i != 3]
        assert [got[user][k] for k in sorted(got[user])] == [i for _, i in sorted(free)[:7]]


def test_recommenders(spark, model, ratings):
    users, items = factor_arrays(model)
    one = spark.createDataFrame([(0,)], "user_id bigint")
    got = als.items_for_users(model.users, model.items, 10, one).orderBy("rank").collect()
    wanted = sorted((-round(float(users[0] @ v), 10), i) for i, v in items.items())[:10]
    assert [(r["item_id"], r["rating"]) for r in got] == [(i, -s) for s, i in wanted]
    assert als.users_for_items(model.users, model.items, 4, spark.createDataFrame([(5,)], "item_id bigint")).count() == 4
    every = als.items_for_users(model.users, model.items, 3)
    assert every.count() == 3 * len(users) and als.users_for_items(model.users, model.items, 2).count() == 2 * len(items)
    names = ratings.select("item_id").distinct().withColumn("name", F.concat(F.lit("n"), F.col("item_id").cast("string")))
    labelled = als.named(every, names).collect()
    assert len(labelled) == 3 * len(users)
    assert all(r["label"].startswith(f"n{r['item_id']},") for r in labelled)


def test_similar_items_leave_out_the_item(model):
    rows = als.similar_items(model.items, 5).collect()
    assert all(r["base"] != r["item"] for r in rows)
    assert {sum(1 for r in rows if r["base"] == b) for b in {r["base"] for r in rows}} == {5}


def test_ids_beyond_32_bits(spark, ratings):
    far = ratings.select((F.col("user_id") + 2**40).alias("user_id"), (F.col("item_id") - 2**41).alias("item_id"), "score")
    model = als.fit(far, 3, 2, 0.1)
    predicted = als.predict(model.users, model.items, far)
    assert predicted.count() == far.count()
    assert predicted.agg(F.min("user_id")).first()[0] >= 2**40


def test_model_round_trip(model, tmp_path):
    path = str(tmp_path / "model")
    model.model.write().overwrite().save(path)
    again = ALSModel.load(path)
    assert again.rank == model.rank and again.itemFactors.exceptAll(model.model.itemFactors).count() == 0


def test_grid_takes_the_first_lowest_error(ratings):
    best, metrics = als.grid_search(ratings, ranks=(3, 4), iterations=(3,), lambdas=(0.1, 10.0))
    rows = metrics.collect()
    assert len(rows) == 4 and sum(r["best"] for r in rows) == 1
    winner = next(r for r in rows if r["best"])
    assert winner["validation_rmse"] == min(r["validation_rmse"] for r in rows)
    assert winner["test_rmse"] is not None and best.rank == winner["rank"]
    assert all(r["test_rmse"] is None for r in rows if not r["best"])


def test_kmeans_assigns_to_the_nearest_centre(spark, folder):
    vectors = inputs.vectors(spark, folder)
    best, metrics = clustering.grid_search(vectors, "embedding", ks=(2, 4), iterations=(5, 10))
    rows = metrics.collect()
    winner = next(r for r in rows if r["best"])
    assert winner["cost"] == min(r["cost"] for r in rows)
    assert next(r for r in rows if r["cost"] == winner["cost"]) == winner
    centres = np.array(best.clusterCenters())
    cost = 0.0
    for r in clustering.assign(best, vectors, "embedding").collect():
        distances = ((centres - np.array(r["embedding"], dtype=float)) ** 2).sum(axis=1)
        assert r["cluster"] == distances.argmin()
        cost += distances.min()
    assert math.isclose(cost, winner["cost"], rel_tol=1e-6)
