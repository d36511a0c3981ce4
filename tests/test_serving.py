from datetime import datetime

from pyspark.sql import functions as F

from sorrel.operators import serving
from sorrel.sinks import serving as sink

T0 = datetime(2024, 1, 1)


def at(text):
    return F.lit(text).cast("timestamp")


def writes(spark, rows, ttl=None):
    df = spark.createDataFrame([(k, v, datetime(2024, 1, d), s) for k, v, d, s in rows], "k string, v string, t timestamp, s bigint")
    return serving.puts(df, "ns", F.col("k"), F.col("v"), F.col("t"), F.col("s"), ttl)


def gone(spark, key, day, seq):
    df = spark.createDataFrame([(key, datetime(2024, 1, day), seq)], "k string, t timestamp, s bigint")
    return serving.deletes(df, "ns", F.col("k"), F.col("t"), F.col("s"))


def view(df, now="2024-06-01 00:00:00"):
    return {r["key"]: r["value"] for r in serving.live(df, at(now)).collect()}


def test_newest_write_wins_and_sequence_breaks_ties(spark):
    log = writes(spark, [("a", "1", 1, 1), ("a", "2", 2, 1), ("b", "x", 3, 1), ("b", "y", 3, 2)])
    assert view(serving.latest(log)) == {"a": "2", "b": "y"}
    assert view(serving.upsert(serving.latest(log), writes(spark, [("a", "3", 4, 0)]))) == {"a": "3", "b": "y"}


def test_expiry_is_at_the_instant(spark):
    state = serving.latest(writes(spark, [("a", "1", 1, 1)], ttl=7))
    assert view(state, "2024-01-07 23:59:59") == {"a": "1"}
    assert view(state, "2024-01-08 00:00:00") == {}
    renewed = serving.upsert(state, writes(spark, [("a", "2", 5, 1)]))
    assert view(renewed, "2025-01-01 00:00:00") == {"a": "2"}


def test_delete_then_add_again(spark):
    log = writes(spark, [("a", "1", 1, 1), ("b", "1", 1, 1)]).unionByName(gone(spark, "a", 2, 1))
    assert view(serving.latest(log)) == {"b": "1"}
    assert view(serving.latest(log.unionByName(writes(spark, [("a", "2", 3, 1)])))) == {"a": "2", "b": "1"}
    keys = spark.createDataFrame([("ns", "b"), ("ns", "b"), ("other", "a")], "namespace string, key string")
    assert view(serving.delete(serving.latest(writes(spark, [("a", "1", 1, 1), ("b", "1", 1, 1)])), keys)) == {"a": "1"}


def test_a_shorter_list_drops_the_old_pages(spark):
    def paged(n, seq):
        ranked = spark.range(n).select(F.lit("u").alias("key"), F.col("id").alias("item"), (F.col("id") + 1).alias("rank"))
        pages = serving.paged_ids(ranked, "key", "item", "rank", per_page=10)
        return serving.puts(pages, "ns", F.col("key"), F.col("value"), F.lit(T0), F.lit(seq), page=F.col("page"))

    first = paged(25, 1)
    rows = sorted((r["page"], r["value"]) for r in serving.latest(first).collect())
    assert [p for p, _ in rows] == [0, 1, 2] and ",".join(v for _, v in rows) == ",".join(map(str, range(25)))
    rows = serving.latest(first.unionByName(paged(4, 2))).collect()
    assert [(r["page"], r["value"]) for r in rows] == [(0, "0,1,2,3")]


def test_repeated_batch_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "kv")
    sink.append_batch(writes(spark, [("a", "1", 1, 1)]), path, 0)
    for _ in range(2):
        sink.append_batch(writes(spark, [("a", "2", 2, 1), ("b", "9", 2, 1)]), path, 1)
    assert sink.read_changes(spark, path).count() == 3
    assert view(serving.latest(sink.read_changes(spark, path))) == {"a": "2", "b": "9"}
    sink.compact(spark, path, str(tmp_path / "kv2"), at("2024-06-01 00:00:00"))
    assert {r["key"]: r["value"] for r in sink.read_changes(spark, str(tmp_path / "kv2")).collect()} == {"a": "2", "b": "9"}


def test_changes_of_some_keys(spark, monkeypatch, capsys, tmp_path):
    path = str(tmp_path / "kv")
    sink.append_batch(writes(spark, [(str(i), "v", 1, 1) for i in range(100)]), path, 0)
    keys = spark.createDataFrame([("5",), ("7",), ("7",), ("500",), (None,)], "key string")
    for bound in (1000, 1):
        monkeypatch.setattr(sink, "IN_LIST_KEYS", bound)
        some = sink.changes_of(sink.read_changes(spark, path), "ns", keys)
        assert sorted(r["key"] for r in some.collect()) == ["5", "7"]
        assert sink.changes_of(sink.read_changes(spark, path), "other", keys).count() == 0
    monkeypatch.setattr(sink, "IN_LIST_KEYS", 1000)
    sink.changes_of(sink.read_changes(spark, path), "ns", keys).explain()
    assert "In(key" in capsys.readouterr().out.split("PushedFilters")[1]


def test_compaction_moves_readers_and_writers(spark, tmp_path):
    path = str(tmp_path / "kv")
    now = at("2024-06-01 00:00:00")
    for batch in range(4):
        sink.append_batch(writes(spark, [("a", str(batch), batch + 1, batch), (f"k{batch}", "x", 1, batch)]), path, batch)
    earlier = sink.read_changes(spark, path)
    sink.compact_version(spark, path, now)
    assert sink.current_folder(spark, path).endswith("/_versions/1") and earlier.count() == 8
    whole = {"a": "3", "k0": "x", "k1": "x", "k2": "x", "k3": "x"}
    assert view(serving.latest(sink.read_changes(spark, path))) == whole
    # The batch that was newest runs again, and finds the state before it.
    before = sink.read_changes(spark, path).where("seq < 3")
    assert view(serving.latest(before)) == {"a": "2", "k0": "x", "k1": "x", "k2": "x"}
    sink.append_batch(writes(spark, [("a", "3", 4, 3), ("k3", "x", 1, 3)]), path, 3)
    assert view(serving.latest(sink.read_changes(spark, path))) == whole
    sink.append_batch(writes(spark, [("a", "4", 5, 4)]), path, 4)
    sink.compact_version(spark, path, now)
    assert view(serving.latest(sink.read_changes(spark, path))) == {**whole, "a": "4"}
    assert sink.current_folder(spark, path).endswith("/_versions/2")


def test_compacted_files_are_in_key_order(spark, tmp_path):
    path, target = str(tmp_path / "kv"), tmp_path / "kv2"
    sink.append_batch(writes(spark, [(str(i * 7919 % 1000), "v", 1, 1) for i in range(1000)]), path, 3)
    sink.compact(spark, path, str(target), at("2024-06-01 00:00:00"))
    total = 0
    for file in target.glob("batch_id=0/*.parquet"):
        keys = [r["key"] for r in spark.read.parquet(str(file)).collect()]
        assert keys == sorted(keys)
        total += len(keys)
    assert total == 1000
