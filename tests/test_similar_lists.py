"""Upkeep of lists: adding and updating must equal a full rebuild."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sorrel.operators import similar_lists as sl
from sorrel.session import materialise

SCHEMA = "id bigint, vec array<double>"


def vectors(n, seed):
    rng = np.random.default_rng(seed)
    return {i: [float(x) for x in rng.normal(size=4)] for i in range(n)}


def frame(spark, rows):
    return spark.createDataFrame(list(rows.items()), SCHEMA)


def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "base bigint")


def shown(lists):
    return {r["base"]: [(e["item"], round(e["sim"], 9)) for e in r["entries"]] for r in lists.collect()}


@pytest.mark.parametrize("seed", range(2))
def test_add_equals_rebuild(spark, seed):
    new = vectors(50, seed)
    old = {i: v for i, v in new.items() if i not in (3, 17, 49)}
    lists = materialise(sl.build(frame(spark, old), "id", "vec"))
    got = sl.apply_add(lists, ids(spark, 3, 17, 49, 49, 777), frame(spark, new), "id", "vec")
    assert shown(got) == shown(sl.build(frame(spark, new), "id", "vec"))


@pytest.mark.parametrize("seed", range(3))
def test_update_equals_rebuild(spark, seed):
    new, moved = vectors(60, seed), (0, 5, 31, 32, 59)
    old = {i: ([-x for x in v] if i in moved else v) for i, v in new.items()}
    lists = materialise(sl.build(frame(spark, old), "id", "vec"))
    got = sl.apply_update(lists, ids(spark, *moved), frame(spark, new), "id", "vec")
    assert shown(got) == shown(sl.build(frame(spark, new), "id", "vec"))


def test_delete_does_not_refill(spark):
    rows = vectors(12, 1)
    lists = materialise(sl.build(frame(spark, rows), "id", "vec"))
    before = shown(lists)
    got = shown(sl.apply_delete(lists, ids(spark, 2, 5, 999)))
    assert got == {b: [e for e in v if e[0] not in (2, 5)] for b, v in before.items() if b not in (2, 5)}


def test_delete_of_all_entries_leaves_an_empty_list(spark):
    lists = materialise(sl.build(frame(spark, vectors(3, 1)), "id", "vec"))
    assert shown(sl.apply_delete(lists, ids(spark, 1, 2))) == {0: []}


def test_short_lists_grow(spark):
    rows = vectors(4, 1)
    lists = materialise(sl.build(frame(spark, {i: rows[i] for i in range(3)}), "id", "vec"))
    got = sl.apply_add(lists, ids(spark, 3), frame(spark, rows), "id", "vec")
    assert shown(got) == shown(sl.build(frame(spark, rows), "id", "vec"))


def test_items_without_a_list_get_none(spark):
    rows = vectors(20, 4)
    lists = materialise(sl.build(frame(spark, rows), "id", "vec").where("base <> 7"))
    assert 7 not in shown(sl.apply_add(lists, ids(spark, 19), frame(spark, rows), "id", "vec"))


def test_tiny_similarities_rank_by_number(spark):
    rows = {0: [1.0, 0.0], 1: [1.0, 1.0], 2: [1.0e-4, 1.0]}
    lists = sl.build(frame(spark, rows), "id", "vec", n=2)
    assert [e[0] for e in shown(lists)[0]] == [1, 2]


def test_latest_change_per_item(spark):
    events = [(1, "add", 5), (2, "delete", 5), (3, "update", 6), (4, "unknown", 6), (5, "delete", None)]
    df = spark.createDataFrame(events, "n int, type string, sid bigint")
    assert {(r["sid"], r["type"]) for r in sl.latest_changes(df, "n").collect()} == {(5, "delete"), (6, "update")}


def test_one_batch_of_all_kinds(spark):
    new = vectors(40, 9)
    old = {i: ([-x for x in v] if i in (4, 8) else v) for i, v in new.items() if i not in (30, 31)}
    lists = materialise(sl.build(frame(spark, old), "id", "vec"))
    changes = spark.createDataFrame(
        [(30, "add"), (31, "add"), (4, "update"), (8, "update"), (1, "delete"), (2, "delete"), (888, "delete")],
        "sid bigint, type string",
    )
    after = shown(sl.apply_changes(lists, changes, frame(spark, new), "id", "vec"))
    live = {i: v for i, v in new.items() if i not in (1, 2)}
    rebuilt = shown(sl.build(frame(spark, live), "id", "vec"))
    assert set(after) == set(live)
    for base in (30, 31, 4, 8):
        assert after[base] == rebuilt[base]
    lost = {b for b, v in shown(lists).items() if {1, 2} & {e[0] for e in v}}
    for base in set(live) - lost:
        assert after[base] == rebuilt[base]
    assert all(not {1, 2} & {e[0] for e in v} for v in after.values())


def test_update_does_not_fill_lists_shortened_by_a_delete(spark):
    rows = vectors(12, 6)
    lists = materialise(sl.build(frame(spark, rows), "id", "vec", n=3))
    shortened = materialise(sl.apply_delete(lists, ids(spark, 3, 7, 9)))
    before = shown(shortened)
    live = {i: v for i, v in rows.items() if i not in (3, 7, 9)}
    live[4] = [-10 * x for x in live[4]]
    after = shown(sl.apply_update(shortened, ids(spark, 4), frame(spark, live), "id", "vec", n=3))
    full = shown(sl.build(frame(spark, live), "id", "vec", n=3))
    for base, old in before.items():
        if base == 4 or (4 in [i for i, _ in old] and 4 not in [i for i, _ in after[base]]):
            assert after[base] == full[base]
        elif 4 not in [i for i, _ in old]:
            assert len(after[base]) == len(old)
            assert all(s >= old[-1][1] for i, s in after[base] if i == 4)


def test_empty_lists_stay_empty_on_update(spark):
    rows = vectors(5, 2)
    lists = spark.createDataFrame([(0, []), (1, [(2, 0.5)])], "base bigint, entries array<struct<item:bigint,sim:double>>")
    assert shown(sl.apply_update(lists, ids(spark, 4), frame(spark, rows), "id", "vec"))[0] == []
