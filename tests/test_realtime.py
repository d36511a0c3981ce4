import pytest
from pyspark.sql import functions as F

from sorrel.operators import realtime


@pytest.fixture()
def scores(spark):
    return spark.createDataFrame([(1, 10, 2.0), (1, 11, 1.0), (2, 10, 0.5), (3, 99, 9.0)], "user_id int, item_id int, score double")


@pytest.fixture()
def lists(spark):
    rows = [(10, [(11, 0.9), (12, 0.5)]), (11, [(12, 0.8), (13, 1.0)]), (50, [(10, 1.0)])]
    return spark.createDataFrame(rows, "base bigint, entries array<struct<item:bigint,sim:double>>")


def test_heaviest_route_counts_and_order_is_by_weight(scores, lists):
    got = [tuple(r) for r in realtime.content_recommendations(scores, lists)
           .select("user_id", "item", "weight", "rank").orderBy("user_id", "rank").collect()]
    assert got == [(1, 11, 1.8, 1), (1, 12, 1.0, 2), (1, 13, 1.0, 3), (2, 11, 0.45, 1), (2, 12, 0.25, 2)]


def test_limit_is_the_head_of_the_full_ranking(scores, lists):
    def rows(df):
        return {(r["user_id"], r["item"], r["rank"]) for r in df.collect()}

    whole = rows(realtime.content_recommendations(scores, lists))
    assert rows(realtime.content_recommendations(scores, lists, limit=2)) == {r for r in whole if r[2] <= 2}


def test_prepared_lists_and_default(spark, scores):
    stored = spark.createDataFrame([("1", 0, "7,8"), ("2", 0, " "), ("9", 0, "1")], "key string, page bigint, value string")

    def rows(default=None):
        return {r["key"]: r["value"] for r in realtime.prepared_recommendations(scores, stored, default).collect()}

    assert rows() == {"1": "7,8"}
    assert rows("4,5") == {"1": "7,8", "2": "4,5", "3": "4,5"}
