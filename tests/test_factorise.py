"""Factors against a plain sequential program, for any partitioning."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sorrel.operators import als, factorise


def plain(ratings, rank, iterations, reg):
    users, items = (sorted({r[i] for r in ratings}) for i in (0, 1))
    start = lambda i, j: int(hashlib.md5(f"als-42-{j}-{i}".encode()).hexdigest()[:13], 16) / 2**52 / np.sqrt(rank)
    y, x = {i: np.array([start(i, j) for j in range(rank)]) for i in items}, {}

    def solved(mine, others, side):
        out = {}
        for m in mine:
            rated = [(others[r[1 - side]], r[2]) for r in ratings if r[side] == m]
            left = sum(np.outer(v, v) for v, _ in rated) + reg * len(rated) * np.eye(rank)
            out[m] = np.linalg.solve(left, sum(s * v for v, s in rated))
        return out

    for _ in range(iterations):
        x = solved(users, y, 0)
        y = solved(items, x, 1)
    return x, y


@pytest.fixture(scope="module")
def rated():
    rng = np.random.default_rng(3)
    rows = [(int(u) * 10**10, int(i) - 20, float(rng.integers(1, 6))) for u in range(30) for i in rng.choice(40, 8, replace=False)]
    # One user and one item hold much of the ratings.
    return rows + [(0, i - 20, 3.0) for i in range(40)] + [(u * 10**10, -20, 2.0) for u in range(30)]


@pytest.mark.parametrize("rank, parts, cell, monkey", [(3, 1, 1 << 20, 1 << 14), (3, 7, 40, 16), (1, 3, 1 << 20, 5)])
def test_factors_are_those_of_a_plain_program(spark, rated, rank, parts, cell, monkey, monkeypatch):
    monkeypatch.setattr(factorise, "CELL", cell)
    monkeypatch.setattr(factorise, "AT_ONCE", monkey)
    frame = spark.createDataFrame([*rated, (None, 1, 1.0), (1, 1, None)], "user_id bigint, item_id bigint, score double").repartition(parts)
    found = factorise.factorise(frame, rank, 3, 0.1)
    users, items = plain(rated, rank, 3, 0.1)
    for side, wanted in ((found.users, users), (found.items, items)):
        got = {r["id"]: np.array(r["features"]) for r in side.collect()}
        assert got.keys() == wanted.keys()
        assert all(np.abs(got[i] - wanted[i]).max() < 1e-8 for i in wanted)


def test_recommenders_take_these_factors(spark, rated):
    frame = spark.createDataFrame(rated, "user_id bigint, item_id bigint, score double")
    found = factorise.factorise(frame, 4, 6, 0.02)
    error = als.predict(found.users, found.items, frame).agg(F.avg((F.col("prediction") - F.col("score")) ** 2)).first()[0]
    spread = np.var([r[2] for r in rated])
    assert error < spread
    assert als.items_for_users(found.users, found.items, 3).count() == 90
