"""Nearest items by bounds: the rows of the block join, and fewer pairs on clustered vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sorrel.operators import pruned, topk
from sorrel.operators.pruned import top_matches_pruned
from sorrel.operators.topk import top_matches


def vectors(spark, n, centres=20, width=12, noise=0.02, seed=1):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, width))
    group = rng.integers(0, centres, n)
    rows = middle[group] + noise * rng.normal(size=(n, width))
    rows[n // 2 : n // 2 + n // 20] = rows[0]  # copies
    rows[1] = 0
    return spark.createDataFrame(
        [(i, r, int(g)) for i, (r, g) in enumerate(zip(rows.tolist(), group.tolist()))], "id bigint, v array<double>, g int"
    ).repartition(4).cache()


def same(found, wanted):
    columns = sorted(wanted.columns)
    one, other = (sorted(map(tuple, f.select(columns).collect())) for f in (found, wanted))
    assert [r[:-1] for r in one] == [r[:-1] for r in other] and len(one) > 0
    score = columns.index("score")
    assert np.allclose([r[score] for r in one], [r[score] for r in other], atol=2e-10)


@pytest.mark.parametrize("metric", ["cosine", "pearson", "euclidean"])
def test_pivots(spark, metric):
    items, report = vectors(spark, 600), []
    found = top_matches_pruned(items, None, 6, metric, "id", "v", block_rows=16, report=report)
    same(found, top_matches(items, None, 6, metric, "id", "v"))
    assert all(r["wave"] != "block join" for r in report)
    assert sum(r["pairs"] for r in report) < 0.4 * 600 * 600


def test_two_sets_and_norms(spark):
    items = vectors(spark, 500)
    scaled = items.withColumn("v", F.transform("v", lambda x: x * F.exp(-F.col("id") / 60)))
    users = vectors(spark, 120, seed=5)
    report = []
    found = top_matches_pruned(users, scaled, 5, "dot", "id", "v", exclude_self=False, block_rows=16, report=report)
    same(found, top_matches(users, scaled, 5, "dot", "id", "v", exclude_self=False))
    assert sum(r["pairs"] for r in report) < 0.5 * 500 * 120
    same(top_matches_pruned(users, items, 3, "cosine", "id", "v", block_rows=16),
         top_matches(users, items, 3, "cosine", "id", "v"))


def test_masked_items_do_not_raise_the_threshold(spark):
    items = vectors(spark, 300).withColumn("v", F.transform("v", lambda x: x * F.exp(-F.col("id") / 40)))
    users = vectors(spark, 40, seed=5)
    seen = users.select(F.col("id").alias("base")).crossJoin(items.select(F.col("id").alias("item"))).where("item < 60 or item % 7 = base % 7")
    found = top_matches_pruned(users, items, 4, "dot", "id", "v", exclude_self=False, exclude=seen, block_rows=16, worth=1.0)
    same(found, top_matches(users, items, 4, "dot", "id", "v", exclude_self=False, exclude=seen))


def test_annuli_of_one_hot_group(spark, monkeypatch):
    monkeypatch.setattr(pruned, "REQUESTS", 50)
    items = vectors(spark, 600, centres=6, noise=0.3).withColumn("g", F.when(F.col("g") < 4, 3).otherwise(F.col("g")))
    items = items.withColumn("v", F.slice("v", 1, 2))
    report = []
    found = top_matches_pruned(items, None, 3, "euclidean", "id", "v", group_col="g", block_rows=16, report=report)
    same(found, top_matches(items, None, 3, "euclidean", "id", "v", group_col="g"))
    sizes = [r["count"] for r in items.groupBy("g").count().collect()]
    assert sum(r["pairs"] for r in report) < sum(n * n for n in sizes)


def test_without_clusters_the_block_join_takes_over(spark):
    items, report = vectors(spark, 400, centres=400, width=40, noise=1.0), []
    same(top_matches_pruned(items, None, 6, "cosine", "id", "v", block_rows=16, report=report), top_matches(items, None, 6, "cosine", "id", "v"))
    assert report[-1]["wave"] == "block join"


def test_pairs_grow_below_quadratic(spark):
    pairs = []
    for n, centres in ((400, 8), (1_600, 32)):
        report = []
        top_matches_pruned(vectors(spark, n, centres), None, 6, "euclidean", "id", "v", block_rows=15, report=report).count()
        pairs.append(sum(r["pairs"] for r in report))
    # Four times the vectors: sixteen times the pairs, of which less than half as many are compared.
    assert pairs[1] < 7 * pairs[0]


def test_large_inputs_try_bounds(spark, monkeypatch):
    monkeypatch.setattr(topk, "PRUNE_PAIRS", 1)
    monkeypatch.setattr(pruned, "BLOCK_ROWS", 16)
    items, asked = vectors(spark, 200), []
    real = pruned.top_matches_pruned
    monkeypatch.setattr(pruned, "top_matches_pruned", lambda *a, **b: asked.append(1) or real(*a, **b))
    same(top_matches(items, None, 3, "cosine", "id", "v"), top_matches(items, None, 3, "cosine", "id", "v", prune=False))
    same(top_matches(items, None, 3, "euclidean", "id", "v", group_col="g"), top_matches(items, None, 3, "euclidean", "id", "v", group_col="g", prune=False))
    assert len(asked) == 2


def test_empty_and_short(spark):
    empty = spark.createDataFrame([], "id bigint, v array<double>, g int")
    assert top_matches_pruned(empty, None, 3, "cosine", "id", "v").count() == 0
    one = spark.createDataFrame([(1, [1.0, 2.0], 1), (2, None, 1), (3, [0.0, 0.0], 1)], "id bigint, v array<double>, g int")
    assert top_matches_pruned(one, None, 3, "cosine", "id", "v").count() == 0
    assert [tuple(r) for r in top_matches_pruned(one, None, 3, "euclidean", "id", "v", group_col="g").select("base", "item").orderBy("base").collect()] == [(1, 3), (3, 1)]
