from pyspark.sql import functions as F

from sorrel.operators.joins import at_most, lookup_join, measured_bytes
from sorrel.operators.ranking import global_index, neighbour_gaps, rank_within, unseen_stretches


def skewed(spark):
    """A third of the rows carry key 0."""
    return spark.range(900).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 17).cast("bigint").alias("k")
    )


def test_lookup_join_is_the_plain_join_either_way(spark, capsys):
    rows = skewed(spark)
    lookup = spark.range(12).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    for how in ("inner", "left"):
        wanted = sorted(map(tuple, rows.join(lookup, "k", how).select("id", "k", "v").collect()))
        for bound in (10_000, 3):
            joined = lookup_join(rows, lookup, ["k"], ["id"], how, broadcast_bytes=bound)
            assert sorted(map(tuple, joined.select("id", "k", "v").collect())) == wanted
    lookup_join(rows, lookup, ["k"], ["id"], broadcast_bytes=3).explain()
    assert "_salt" in capsys.readouterr().out


def test_at_most(spark):
    assert at_most(spark.range(5), 5) and not at_most(spark.range(6), 5)


def test_global_index_is_dense_and_ordered(spark):
    df = spark.range(1000).select(F.pmod(F.xxhash64("id"), F.lit(10_000)).alias("a"), "id").repartition(7)
    got = global_index(df, [F.col("a"), F.col("id")]).collect()
    got.sort(key=lambda r: r["index"])
    assert [r["index"] for r in got] == list(range(1000))
    assert [(r["a"], r["id"]) for r in got] == sorted((r["a"], r["id"]) for r in got)


def test_global_index_of_nothing(spark):
    assert global_index(spark.range(0), [F.col("id")]).count() == 0


def test_rank_within_a_hot_key(spark):
    rows = skewed(spark)
    ranked = rank_within(rows, "k", [F.col("id").desc()])
    by_key = {}
    for r in ranked.collect():
        by_key.setdefault(r["k"], []).append((r["rank"], r["id"]))
    assert sum(map(len, by_key.values())) == 900
    for pairs in by_key.values():
        pairs.sort()
        assert [p[0] for p in pairs] == list(range(1, len(pairs) + 1))
        assert [p[1] for p in pairs] == sorted((p[1] for p in pairs), reverse=True)


def test_neighbour_gaps(spark):
    seen = {1: [0, 1, 5], 2: [9], 3: list(range(10)), 4: [3, 4, 8]}
    df = spark.createDataFrame([(u, p) for u, ps in seen.items() for p in ps], "u int, p bigint")
    got = {}
    for r in neighbour_gaps(df, "u", "p", 10).collect():
        got.setdefault(r["u"], set()).update(range(r["first"], r["last"] + 1))
    assert got == {u: set(range(10)) - set(ps) for u, ps in seen.items() if len(ps) < 10}


def test_measuring_sends_one_number_per_task(spark, capsys):
    df = spark.range(1000).select("id", F.repeat(F.lit("x"), 100).alias("t"), F.array(F.lit(1.0), F.lit(2.0)).alias("v"))
    assert 150_000 < measured_bytes(df) < 250_000 and measured_bytes(df.limit(0)) == 0
    assert measured_bytes(spark.sql("select map('a', struct(1 as x)) as m, null as n")) > 0


def test_ranks_when_one_key_fills_many_partitions(spark):
    df = spark.range(2000).select(F.when(F.col("id") < 1900, 5).otherwise(F.col("id") % 3).alias("k"), "id")
    got = {}
    for r in rank_within(df, "k", [F.col("id")]).collect():
        got.setdefault(r["k"], []).append((r["id"], r["rank"]))
    for rows in got.values():
        assert [rank for _, rank in sorted(rows)] == list(range(1, len(rows) + 1))


def test_ranks_of_null_keys_and_of_nothing(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 3)], "k int, id int")
    assert sorted((r["id"], r["rank"]) for r in rank_within(df, "k", [F.col("id")]).collect()) == [(1, 1), (2, 2), (3, 1)]
    assert rank_within(df.limit(0), "k", [F.col("id")]).count() == 0
    assert neighbour_gaps(df.limit(0).withColumn("p", F.col("id")), "k", "p", 4).count() == 0


def test_users_without_catalogue_items_get_the_whole_catalogue(spark):
    seen = spark.createDataFrame([(1, 10), (1, 30), (2, 99), (3, 10), (3, 20), (3, 30), (None, 10), (4, None)], "user_id int, item_id bigint")
    catalogue = spark.createDataFrame([(10,), (20,), (30,), (30,), (None,)], "item_id bigint")
    got = sorted(map(tuple, unseen_stretches(seen, catalogue).collect()))
    assert got == [(1, 1, 1), (2, 0, 2), (4, 0, 2)]
