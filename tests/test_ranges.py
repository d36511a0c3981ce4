import random

import pytest
from pyspark.sql import functions as F

from sorrel.operators.ranges import ip_location, locate, location_counts

RANGES = [
    (0, 4294967295, "all"), (16777216, 33554431, "wide"), (16777216, 16777471, "first"), (16777300, 16777300, "one"),
    (16777290, 16777320, "mid-b"), (16777290, 16777320, "mid-a"), (16777295, 16777325, "mid-later"),
    (3000000000, 2999999999, "backwards"),
]


def best(number, ranges):
    hits = [(hi - lo, lo, label) for lo, hi, label in ranges if lo <= number <= hi]
    return min(hits)[2] if hits else None


def frame(spark, ranges):
    return spark.createDataFrame(ranges, "start bigint, end bigint, location string")


def check(spark, numbers, ranges):
    log = spark.createDataFrame(list(enumerate(numbers)), "id bigint, ip_num bigint")
    got = {r["id"]: r["location"] for r in ip_location(log, frame(spark, ranges), "ip_num", ["id"]).collect()}
    assert got == {i: None if n is None else best(n, ranges) for i, n in enumerate(numbers)}


def test_edges_overlaps_gaps_and_the_whole_space(spark):
    edges = [n + d for lo, hi, _ in RANGES for n in (lo, hi) for d in (-1, 0, 1) if 0 <= n + d <= 4294967295]
    check(spark, edges + [None], RANGES)
    check(spark, edges, [r for r in RANGES if r[2] != "all"])


@pytest.mark.parametrize("seed", range(3))
def test_random_ranges(spark, seed):
    rng = random.Random(seed)
    ranges = []
    for i in range(60):
        lo = rng.randrange(1 << 20)
        ranges.append((lo, lo + rng.choice([0, 1, 7, 255, 5000, 200_000]), f"r{i}"))
    check(spark, [rng.randrange(1 << 21) for _ in range(300)], ranges)


def test_counts_with_a_busy_address(spark):
    numbers = [16777300] * 400 + [16777217] * 3 + [5] * 2 + [None]
    log = spark.createDataFrame([(n,) for n in numbers], "ip_num bigint")
    narrow = frame(spark, [r for r in RANGES if r[2] != "all"])
    counts = {r["location"]: r["ip_count"] for r in location_counts(log, narrow, "ip_num").collect()}
    assert counts == {"one": 400, "first": 3}
    counts = {r["location"]: r["ip_count"] for r in location_counts(log, narrow, "ip_num", unmatched=True).collect()}
    assert counts == {"one": 400, "first": 3, None: 3}


def test_plan_joins_by_equality(spark, capsys):
    log = spark.range(1000).select((F.col("id") + 16777216).alias("ip_num"))
    locate(log, frame(spark, RANGES), "ip_num").explain()
    plan = capsys.readouterr().out
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan and "Cartesian" not in plan
