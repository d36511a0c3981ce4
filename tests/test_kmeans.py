"""K-means with bounds against plain Lloyd steps."""

import numpy as np
import pytest

from sorrel.operators import kmeans


def items(spark, n=600, centres=8, width=5, seed=1, parts=4):
    rng = np.random.default_rng(seed)
    middle = 3 * rng.normal(size=(centres, width))
    rows = middle[rng.integers(0, centres, n)] + rng.normal(size=(n, width)) * 0.4
    rows[n // 2 :][:30] = rows[0]
    frame = spark.createDataFrame(list(enumerate(rows.tolist())), "id bigint, vec array<double>").repartition(parts)
    return rows, frame


def plain(rows, centres, steps):
    for _ in range(steps):
        nearest = ((rows[:, None] - centres) ** 2).sum(axis=2).argmin(axis=1)
        centres = np.array([rows[nearest == c].mean(axis=0) if (nearest == c).any() else centres[c] for c in range(len(centres))])
    away = ((rows[:, None] - centres) ** 2).sum(axis=2)
    return centres, away.argmin(axis=1), away.min(axis=1).sum()


@pytest.mark.parametrize("parts", [1, 5])
def test_steps_are_those_of_a_plain_program(spark, parts):
    rows, frame = items(spark, parts=parts)
    start = kmeans.hash_seeds(frame, 6)
    for found in kmeans.lloyd(kmeans.prepared(frame, "id", "vec"), start, 7, (2, 4)):
        centres, nearest, cost = plain(rows, start, found.iterations)
        assert np.abs(found.centres - centres).max() < 1e-9 and abs(found.cost - cost) < 1e-6
        assert {r["id"]: r["cluster"] for r in found.assigned.collect()} == dict(enumerate(nearest.tolist()))
    assert found.iterations == 7
    # Without bounds each step measures every item against every centre.
    assert found.measured < 0.6 * 7 * 6 * len(rows)


def test_seeds_do_not_depend_on_partitions_and_reach_all_clusters(spark):
    rows, one = items(spark, parts=1)
    _, other = items(spark, parts=6)
    found = kmeans.parallel_seeds(one, 8)
    assert np.array_equal(found, kmeans.parallel_seeds(other, 8)) and len(found) == 8
    cost = kmeans.lloyd(one, found, 5)[-1].cost
    assert cost < 0.5 * ((rows - rows.mean(axis=0)) ** 2).sum() / 8


def test_grid_shares_runs_and_stops_when_nothing_moves(spark):
    _, frame = items(spark, n=200, centres=3)
    best, metrics = kmeans.grid_search(frame, "id", "vec", (2, 3), (1, 3, 40))
    rows = metrics.collect()
    assert [(r["k"], r["iterations"]) for r in rows] == [(k, i) for k in (2, 3) for i in (1, 3, 40)]
    assert best.cost == min(r["cost"] for r in rows) and sum(r["best"] for r in rows) == 1
    copies = spark.createDataFrame([(i, [1.0, 1.0]) for i in range(5)], "id bigint, vec array<double>")
    assert kmeans.grid_search(copies, "id", "vec", (2,), (3,))[0].cost == 0
