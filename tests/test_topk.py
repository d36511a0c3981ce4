"""The block kernel against brute force, with hot groups, twins and awkward vectors."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from sorrel.operators import topk
from sorrel.functions.similarity import adjusted_cosine
from sorrel.operators import few as few_module
from sorrel.operators.few import best_for_few, best_of_few
from sorrel.operators.topk import as_lists, nearest_to_one, top_matches

SCHEMA = "id bigint, vec array<double>"


def brute(base, items, k, metric, same_group=None, exclude=()):
    wanted = {}
    for b, x in base.items():
        scored = []
        for i, y in items.items():
            if i == b or (b, i) in exclude or (same_group and same_group[b] != same_group[i]):
                continue
            x_, y_ = np.array(x), np.array(y)
            if metric == "pearson":
                x_, y_ = x_ - x_.mean(), y_ - y_.mean()
            if metric == "euclidean":
                s = -np.sqrt(((x_ - y_) ** 2).sum())
            elif metric == "dot":
                s = x_ @ y_
            else:
                d = np.sqrt(x_ @ x_) * np.sqrt(y_ @ y_)
                if d < 1e-12:
                    continue
                s = x_ @ y_ / d
            scored.append((-round(s, 10), i))
        wanted[b] = [i for _, i in sorted(scored)[:k]]
    return {b: v for b, v in wanted.items() if v}


def found(df):
    out = {}
    for r in df.orderBy("base", "rank").collect():
        out.setdefault(r["base"], []).append(r["item"])
    return out


@pytest.fixture()
def small_blocks(monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 20)
    monkeypatch.setattr(topk, "SMALLEST_BLOCK", 10)
    monkeypatch.setattr(topk, "SLICE_SCORES", 64)


def data(n, dim=5, seed=1):
    rng = np.random.default_rng(seed)
    rows = {i: [float(v) for v in rng.integers(-3, 4, dim)] for i in range(n)}
    rows[3] = [0.0] * dim
    rows[4] = [2.0] * dim
    for twin in range(10, 10 + n // 3):
        rows[twin] = list(rows[5])
    return rows


@pytest.mark.parametrize("scale", [1e-6, 1.0, 1e6])
def test_distances_between_close_points_far_from_the_origin(spark, small_blocks, scale):
    rng = np.random.default_rng(8)
    rows = {i: [float(v) for v in scale * (1000 + 1e-4 * rng.normal(size=6))] for i in range(60)}
    for twin in range(40, 60):
        rows[twin] = list(rows[5])
    df = spark.createDataFrame(list(rows.items()), SCHEMA)
    assert found(top_matches(df, None, 4, "euclidean", "id", "vec")) == brute(rows, rows, 4, "euclidean")


@pytest.mark.parametrize("metric", ["cosine", "pearson", "euclidean", "dot"])
def test_self_comparison(spark, small_blocks, metric):
    rows = data(90)
    df = spark.createDataFrame(list(rows.items()), SCHEMA)
    assert found(top_matches(df, None, 4, metric, "id", "vec")) == brute(rows, rows, 4, metric)


def test_subset_against_all(spark, small_blocks):
    rows = data(70)
    some = {i: rows[i] for i in (0, 3, 12, 69)}
    base, items = (spark.createDataFrame(list(x.items()), SCHEMA) for x in (some, rows))
    assert found(top_matches(base, items, 6, "cosine", "id", "vec")) == brute(some, rows, 6, "cosine")


def test_hot_group_is_cut_and_exact(spark, small_blocks):
    rows = data(90)
    group = {i: 0 if i < 60 else i % 4 for i in rows}
    df = spark.createDataFrame([(i, v, group[i]) for i, v in rows.items()], SCHEMA + ", g int")
    got = top_matches(df, None, 3, "euclidean", "id", "vec", group_col="g")
    assert found(got) == brute(rows, rows, 3, "euclidean", same_group=group)


def test_excluded_pairs_and_a_base_that_has_seen_everything(spark, small_blocks):
    rng = np.random.default_rng(2)
    users = {i: [float(v) for v in rng.normal(size=4)] for i in range(45)}
    items = {i: [float(v) for v in rng.normal(size=4)] for i in range(100, 155)}
    seen = {(0, i) for i in items} | {(u, i) for u in users for i in items if (u * i) % 3 == 0} | {(999, 100), (1, 9999)}
    got = top_matches(
        spark.createDataFrame(list(users.items()), SCHEMA), spark.createDataFrame(list(items.items()), SCHEMA),
        7, "dot", "id", "vec", exclude_self=False,
        exclude=spark.createDataFrame(sorted(seen), "base bigint, item bigint"),
    )
    wanted = brute(users, items, 7, "dot", exclude=seen)
    assert 0 not in wanted and found(got) == wanted


def test_fewer_items_than_k_and_missing_vectors(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, None)], SCHEMA)
    assert found(top_matches(df, None, 6, "cosine", "id", "vec")) == {1: [2], 2: [1]}


def test_empty_side(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0])], SCHEMA)
    assert top_matches(df, df.limit(0), 6, "cosine", "id", "vec").count() == 0
    assert top_matches(df.limit(0), None, 6, "cosine", "id", "vec").count() == 0


def test_lengths_must_agree(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0])], SCHEMA)
    with pytest.raises(Exception, match="vectors differ in length"):
        top_matches(df, None, 6, "cosine", "id", "vec").collect()


@pytest.mark.parametrize("metric", ["euclidean", "pearson", "cosine"])
def test_one_query(spark, metric):
    rows = data(60)
    df = spark.createDataFrame(list(rows.items()), SCHEMA)
    got = [r["item"] for r in nearest_to_one(df, 5, 6, metric, "id", "vec").collect()]
    assert got == brute({5: rows[5]}, rows, 6, metric)[5]
    assert nearest_to_one(df, 12345, 6, metric, "id", "vec").count() == 0


def test_lists_keep_bases_without_matches(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [0.0, 0.0])], SCHEMA)
    lists = as_lists(df.select(F.col("id").alias("base")), top_matches(df, None, 6, "cosine", "id", "vec"))
    assert {r["base"]: len(r["entries"]) for r in lists.collect()} == {1: 1, 2: 1, 3: 0}


def test_group_limit_in_the_plan(spark, capsys):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], SCHEMA)
    top_matches(df, None, 6, "cosine", "id", "vec").explain()
    assert "WindowGroupLimit" in capsys.readouterr().out


def test_rows_without_an_id_or_vector_are_left_out(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 1.0]), (None, [1.0, 0.5]), (4, None)], SCHEMA)
    assert found(top_matches(df, None, 6, "cosine", "id", "vec")) == {1: [2], 2: [1]}
    few = df.where("id = 1")
    assert found(best_of_few(df, few, 6, "cosine", "id", "vec")) == {2: [1]}
    assert found(best_for_few(few, df, 6, "cosine", "id", "vec")) == {1: [2]}


@pytest.mark.parametrize("metric", ["cosine", "pearson", "euclidean", "adjusted_cosine", "dot"])
@pytest.mark.parametrize("limit", [few_module.FEW_BYTES, 0])
def test_few_against_many_equals_the_block_join(spark, small_blocks, monkeypatch, metric, limit):
    rows = data(80)
    some = {i: rows[i] for i in (0, 3, 12, 69)}
    base, items = (spark.createDataFrame(list(x.items()), SCHEMA) for x in (some, rows))
    one, other = found(top_matches(base, items, 6, metric, "id", "vec")), found(top_matches(items, base, 6, metric, "id", "vec"))
    monkeypatch.setattr(few_module, "FEW_BYTES", limit)
    assert found(best_for_few(base, items, 6, metric, "id", "vec")) == one
    assert found(best_of_few(items, base, 6, metric, "id", "vec")) == other


def test_adjusted_cosine_follows_the_column_form(spark, small_blocks):
    df = spark.createDataFrame(list(data(60).items()), SCHEMA)
    best = top_matches(df, None, 3, "adjusted_cosine", "id", "vec")
    one, other = (df.select(F.col("id").alias(n), F.col("vec").alias(v)) for n, v in (("base", "x"), ("item", "y")))
    score = F.abs(adjusted_cosine(F.col("x"), F.col("y")) - F.col("score"))
    assert best.join(one, "base").join(other, "item").agg(F.max(score)).first()[0] < 1e-9


@pytest.mark.parametrize("level", [0.0, 1e6, 1e9])
@pytest.mark.parametrize("steps", [1, 3])
def test_adjusted_cosine_at_a_large_common_level(spark, small_blocks, level, steps):
    rng = np.random.default_rng(5)
    centres = rng.integers(-40, 41, (4, 6))
    rows = {i: [float(v) / 32 + level * (i % steps) for v in centres[i % 4] + rng.integers(-3, 4, 6)] for i in range(70)}
    wanted = {}
    for b, x in rows.items():
        scored = []
        for i, y in rows.items():
            one, other = [[Fraction(v) for v in z] for z in (x, y)]
            mean = sum(one + other) / 12
            one, other = [v - mean for v in one], [v - mean for v in other]
            square = sum(v * v for v in one) * sum(v * v for v in other)
            if i != b and square:
                score = float(sum(v * w for v, w in zip(one, other))) / math.sqrt(square)
                scored.append((-round(score, 10), i))
        wanted[b] = [i for _, i in sorted(scored)[:4]]
    df = spark.createDataFrame(list(rows.items()), SCHEMA)
    assert found(top_matches(df, None, 4, "adjusted_cosine", "id", "vec")) == wanted


def test_the_large_side_is_not_shuffled(spark, capsys):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], SCHEMA)
    best_of_few(df, df, 1, "euclidean", "id", "vec", exclude_self=False).explain()
    assert "Exchange" not in capsys.readouterr().out
