"""Streams over arriving files: batches, restarts, rejects and list upkeep."""

import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from sorrel.functions.lists import decode_scored
from sorrel.operators import similar_lists
from sorrel.operators.serving import latest, live, lookup, puts
from sorrel.plans.content import list_puts
from sorrel.schemas import OFFLINE_ALS, OFFLINE_CB, ONLINE_ALS, ONLINE_CB
from sorrel.sinks.serving import append_batch, read_changes
from sorrel.sources.streams import behaviour_stream, change_stream
from sorrel.streaming import changes, realtime


def stamp():
    return F.lit("2024-01-01 00:00:00").cast("timestamp")


def arrive(folder, name, lines, order):
    path = folder / name
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    os.utime(path, (1_700_000_000 + order, 1_700_000_000 + order))


def values(spark, path, namespace):
    return {r["key"]: r["value"] for r in lookup(latest(read_changes(spark, path)), namespace, F.current_timestamp()).collect()}


@pytest.fixture()
def lists_path(spark, tmp_path):
    path = str(tmp_path / "lists")
    cb = spark.createDataFrame([("10", "11:0.9,12:0.5"), ("11", "12:0.8,13:1.0"), ("12", "")], "k string, v string")
    als = spark.createDataFrame([("1", "7,8")], "k string, v string")
    both = puts(cb, OFFLINE_CB, F.col("k"), F.col("v"), stamp(), F.lit(0)).unionByName(
        puts(als, OFFLINE_ALS, F.col("k"), F.col("v"), stamp(), F.lit(0))
    )
    append_batch(both, path, 0)
    return path


def test_batches_restart_and_rejects(spark, tmp_path, lists_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    online, rejects, checkpoint = (str(tmp_path / n) for n in ("online", "rejects", "checkpoint"))
    writer = realtime.batch_writer(lists_path, online, rejects, default_list="4,5")

    def drain():
        stream = behaviour_stream(spark, "files", str(inbox), {"maxFilesPerTrigger": "1"})
        query = realtime.start(stream, writer, checkpoint, drain=True)
        assert query.awaitTermination(180)
        if query.exception():
            raise query.exception()

    arrive(inbox, "a.txt", ["1,收藏,10", "1,浏览,11", "", "junk", "2,浏览,10,"], 1)
    arrive(inbox, "b.txt", ["2,收藏,11"], 2)
    drain()
    # Weights of user 1: 11 is 0.9*0.55, 12 the larger of 0.5*0.55 and 0.8*0.15, 13 is 1.0*0.15.
    assert values(spark, online, ONLINE_CB) == {"1": "11,12,13", "2": "13,12"}
    assert values(spark, online, ONLINE_ALS) == {"1": "7,8", "2": "4,5"}
    assert sorted(r["reject_reason"] for r in spark.read.parquet(rejects).collect()) == ["arity", "blank"]

    before = read_changes(spark, online).count()
    drain()
    assert read_changes(spark, online).count() == before
    # A batch that ran but was not committed runs again under its number.
    replay = spark.createDataFrame([("2,收藏,11",)], "value string")
    writer(replay, 1)
    assert read_changes(spark, online).count() == before
    arrive(inbox, "c.txt", ["1,评价,99"], 3)
    drain()
    assert values(spark, online, ONLINE_CB) == {"1": "11,12,13", "2": "13,12"}
    expiry = read_changes(spark, online).select((F.col("expires_at") - F.col("written_at")).cast("string")).distinct().collect()
    assert [r[0] for r in expiry] == ["INTERVAL '7 00:00:00' DAY TO SECOND"]


def test_item_changes_keep_the_lists_exact(spark, tmp_path):
    rng = np.random.default_rng(5)
    rows = {i: [float(x) for x in rng.normal(size=4)] for i in range(30)}
    inbox, path = tmp_path / "changes", str(tmp_path / "lists")
    inbox.mkdir()
    catalogue = {"now": {i: v for i, v in rows.items() if i != 29}}

    def read(session):
        return session.createDataFrame(list(catalogue["now"].items()), "id bigint, vec array<double>")

    append_batch(list_puts(similar_lists.build(read(spark), "id", "vec"), stamp()), path, 0)
    writer = changes.batch_writer(path, read, "id", "vec")

    def send(name, order, *events):
        arrive(inbox, name, [json.dumps({"type": t, "sid": s}) for t, s in events], order)
        stream = change_stream(spark, "files", str(inbox), {"maxFilesPerTrigger": "1"})
        query = realtime.start(stream, writer, str(tmp_path / "checkpoint"), drain=True)
        assert query.awaitTermination(240)
        if query.exception():
            raise query.exception()

    def stored():
        state = live(latest(read_changes(spark, path)), F.current_timestamp())
        rows = state.select("key", decode_scored(F.col("value")).alias("e")).collect()
        return {int(r["key"]): [(e["item"], round(e["sim"], 8)) for e in r["e"]] for r in rows}

    def rebuilt():
        lists = similar_lists.build(read(spark), "id", "vec").collect()
        return {r["base"]: [(e["item"], round(e["sim"], 8)) for e in r["entries"]] for r in lists}

    assert stored() == rebuilt()
    catalogue["now"] = dict(rows)
    catalogue["now"][3] = [-x for x in rows[3]]
    send("a.json", 1, ("delete", 29), ("add", 29), ("update", 3), ("rename", 4))
    assert stored() == rebuilt()
    wanted = {b: [e for e in v if e[0] != 7] for b, v in stored().items() if b != 7}
    send("b.json", 2, ("add", 7), ("delete", 7))
    assert stored() == wanted
    size = read_changes(spark, path).count()
    writer(spark.createDataFrame([("delete", 7, (1, "f", 0))], "type string, sid bigint, sequence struct<a:int,b:string,c:int>"), 1)
    assert read_changes(spark, path).count() == size and stored() == wanted


def test_latest_is_live_only(spark, lists_path):
    assert set(values(spark, lists_path, OFFLINE_CB)) == {"10", "11", "12"}
