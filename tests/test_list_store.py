"""Lists in blocks: the rows of the plain upkeep, and only blocks touched that a change can alter."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sorrel.operators import similar_lists
from sorrel.session import materialise
from sorrel.sinks.list_store import ListStore
from sorrel.sinks.serving import read_changes
from sorrel.streaming.changes import block_writer

SCHEMA = "id bigint, vec array<double>"


def clustered(n=240, centres=12, width=6, seed=2):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, width))
    return {i: (middle[i % centres] + 0.05 * rng.normal(size=width)).tolist() for i in range(n)}


def frame(spark, rows):
    return spark.createDataFrame(list(rows.items()), SCHEMA)


def changes(spark, *rows):
    return spark.createDataFrame(list(rows), "sid bigint, type string")


def shown(lists):
    return {r["base"]: [(e["item"], round(e["sim"], 9)) for e in r["entries"]] for r in lists.collect()}


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    rows = clustered()
    store = ListStore(spark, str(tmp_path_factory.mktemp("lists")), n=4)
    store.create(frame(spark, rows), "id", "vec", block_rows=20)
    return rows, store


def files(store, batch):
    from pathlib import Path

    return sorted(int(p.parent.name.split("=")[1]) for p in Path(store.path, "lists").glob(f"block=*/batch={batch}"))


def test_store_holds_all_lists(spark, made):
    rows, store = made
    assert shown(store.lists(before=1)) == shown(similar_lists.build(frame(spark, rows), "id", "vec", 4))


def test_one_change_touches_few_blocks_and_changes_as_the_plain_upkeep(spark, made):
    rows, store = made
    rng = np.random.default_rng(7)
    now = dict(rows)
    batches = [
        [(500, "add")], [(3, "update")], [(10, "delete")], [(501, "add"), (4, "update"), (11, "delete"), (999, "delete")], [(500, "update")],
    ]
    for batch, events in enumerate(batches, 1):
        for sid, kind in events:
            if kind == "delete":
                now.pop(sid, None)
            elif kind == "add":
                now[sid] = (np.array(now[24]) + 0.01 * rng.normal(size=6)).tolist()
            else:
                now[sid] = (np.array(now[29]) + 0.01 * rng.normal(size=6)).tolist()
        catalogue = materialise(frame(spark, now))
        before = materialise(store.lists(before=batch))
        wanted = shown(similar_lists.apply_changes(before, changes(spark, *events), catalogue, "id", "vec", 4))
        blocks = len([m for m in store._meta(batch) if m["size"]])
        for _ in range(2 if batch == 2 else 1):  # a batch that is run again changes nothing
            old, new, touched = store.apply(changes(spark, *events), catalogue, "id", "vec", batch)
            assert shown(store.lists()) == wanted
        assert len(touched.blocks_read) <= blocks // 2 if len(events) == 1 else len(touched.blocks_read) < blocks
        assert touched.lists_read < len(now) and touched.lists_written <= touched.lists_read + len(events)
        assert set(files(store, batch)) <= set(touched.blocks_written) <= set(touched.blocks_read) | {-1}


def test_vector_without_direction_and_emptied_block(spark, tmp_path):
    rows = {**clustered(40, 4), 77: [0.0] * 6}
    store = ListStore(spark, str(tmp_path / "s"), n=3)
    store.create(frame(spark, rows), "id", "vec", block_rows=10)
    assert shown(store.lists())[77] == []
    rows[77] = rows[0]
    store.apply(changes(spark, (77, "update")), frame(spark, rows), "id", "vec", 1)
    gone = [i for i in range(40) if i % 4 == 1]
    left = {i: v for i, v in rows.items() if i not in gone}
    before = materialise(store.lists())
    store.apply(changes(spark, *[(i, "delete") for i in gone]), frame(spark, left), "id", "vec", 2)
    wanted = similar_lists.apply_changes(before, changes(spark, *[(i, "delete") for i in gone]), frame(spark, left), "id", "vec", 3)
    assert shown(store.lists()) == shown(wanted) and any(not m["size"] for m in store._meta(None))
    store.apply(changes(spark, (1, "add")), frame(spark, {**left, 1: rows[1]}), "id", "vec", 3)
    assert len(shown(store.lists())[1]) == 3


def test_stream_batches_store_only_changed_lists(spark, tmp_path):
    rows = clustered(60, 6)
    store, served, touched = ListStore(spark, str(tmp_path / "s"), n=3), str(tmp_path / "served"), []
    store.create(frame(spark, rows), "id", "vec", block_rows=10)
    rows[61] = rows[7]
    writer = block_writer(store, served, lambda s: frame(s, rows), "id", "vec", touched)
    batch = spark.createDataFrame([("a", "add", 61)], "sequence string, type string, sid bigint")
    writer(batch, 0)
    writer(batch.limit(0), 1)
    lists, log = shown(store.lists()), read_changes(spark, served).where(F.col("seq") == 1)
    held = {b for b, v in lists.items() if b == 61 or 61 in [i for i, _ in v]}
    assert {int(r["key"]) for r in log.collect()} == held and len(touched) == 1
    assert touched[0].lists_read < len(rows)
