"""Location by sweep against every range in turn."""

import random

import numpy as np
import pytest

from sorrel.operators import sweep
from sorrel.operators.ranges import locate
from sorrel.operators.sweep import locate_by_sweep, paint


def best(number, ranges):
    hits = [(hi - lo, lo, label) for lo, hi, label in ranges if lo <= number <= hi and lo >= 0 and hi < 2**32]
    return min(hits)[2] if hits else None


def test_paint():
    low, high, got = paint(np.array([0, 5, 5, 20]), np.array([30, 9, 7, 22]), np.array([9, 4, 1, 3]))
    assert list(zip(low, high, got)) == [(0, 4, 9), (5, 7, 1), (8, 9, 4), (10, 19, 9), (20, 22, 3), (23, 30, 9)]
    assert len(paint(*(np.zeros(0, np.int64),) * 3)[0]) == 0


@pytest.mark.parametrize("chunk_rows", [1 << 18, 5])
def test_nested_wide_and_hot_ranges(spark, chunk_rows, monkeypatch):
    monkeypatch.setattr(sweep, "CHUNK_ROWS", chunk_rows)
    rnd = random.Random(chunk_rows)
    ranges = [(0, 2**32 - 1, "all"), (5, 4, "backwards"), (-4, 9, "outside"), (7, 7, "b"), (7, 7, "a"), (2**31, 2**32 - 1, "upper")]
    for n in range(150):
        low = rnd.choice([rnd.randrange(2**32), 10**9, 10**9 + rnd.randrange(10**4)])
        ranges.append((low, min(2**32 - 1, low + rnd.choice([0, 3, 1000, 10**6, 10**9])), f"r{n}"))
    numbers = {rnd.randrange(2**32) for _ in range(150)} | {x + d for lo, hi, _ in ranges[6:60] for x in (lo, hi) for d in (-1, 0, 1)}
    numbers = sorted(x for x in numbers if x >= 0) + [None, -1, 2**32]
    asked = spark.createDataFrame([(n, i) for i, n in enumerate(numbers)], "ip_num bigint, tag int").repartition(3)
    frame = spark.createDataFrame(ranges, "start bigint, end bigint, location string")
    found = locate_by_sweep(asked, frame, keep=("tag",)).collect()
    wanted = {n: best(n, ranges) for n in numbers if n is not None and 0 <= n < 2**32}
    assert {r["ip_num"]: r["location"] for r in found} == {n: w for n, w in wanted.items() if w is not None}
    assert len(found) == len({r["ip_num"] for r in found}) and all(numbers[r["tag"]] == r["ip_num"] for r in found)


def test_gaps_and_empty_tables(spark):
    frame = spark.createDataFrame([(10, 20, "x"), (21, 25, "x2"), (40, 50, "y")], "start bigint, end bigint, location string")
    asked = spark.createDataFrame([(n,) for n in range(60)], "ip_num bigint")
    assert sorted(map(tuple, locate_by_sweep(asked, frame).collect())) == sorted(map(tuple, locate(asked, frame).collect()))
    assert locate_by_sweep(asked, frame.limit(0)).count() == 0 and locate_by_sweep(asked.limit(0), frame).count() == 0
