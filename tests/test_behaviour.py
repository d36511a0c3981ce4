from sorrel import schemas
from sorrel.operators import behaviour


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_parse_and_quarantine(spark):
    df = lines(
        spark, "1,浏览,10", " 2 , 收藏 , 20 ", "3,评价,30,", "3,评价,30,,", "", "   ", None, "1,浏览", "1,浏览,", "1,浏览,5,6",
        "x,浏览,5", "1,浏览,y", "1,other,5", "99999999999,浏览,5", "99999999999999999999,浏览,5",
    )
    parsed = behaviour.parse_messages(df)
    good = [tuple(r) for r in behaviour.accepted(parsed).collect()]
    assert good == [(1, "浏览", 10), (2, "收藏", 20), (3, "评价", 30), (3, "评价", 30), (1, "other", 5), (99999999999, "浏览", 5)]
    reasons = [r["reject_reason"] for r in behaviour.rejected(parsed).collect()]
    assert reasons == ["blank", "blank", "blank", "arity", "arity", "arity", "number", "number", "number"]


def test_scores_with_both_weights(spark):
    rows = [(1, "浏览", 7)] * 2 + [(1, "收藏", 7), (1, "评价", 7), (1, "other", 8), (2, "评价", 7)]
    df = spark.createDataFrame(rows, "user_id int, operation string, item_id int")
    got = {(r[0], r[1]): round(r[2], 9) for r in behaviour.score(df).collect()}
    assert got == {(1, 7): round(2 * 1.15 + 1.55 + 1.30, 9), (1, 8): 0.0, (2, 7): 1.30}
    got = {(r[0], r[1]): round(r[2], 9) for r in behaviour.score(df, schemas.STREAM_WEIGHTS).collect()}
    assert got == {(1, 7): round(2 * 0.15 + 0.55 + 0.30, 9), (1, 8): 0.0, (2, 7): 0.30}


def test_indexed_rating_text(spark):
    df = lines(spark, "((1,2,1.15),0)", "((3,4,2.7),1)", "((3,4),1)", "", "((a,4,2.7),1)")
    parsed = behaviour.parse_indexed_ratings(df)
    assert [tuple(r) for r in behaviour.accepted_ratings(parsed).collect()] == [(1, 2, 1.15, 0), (3, 4, 2.7, 1)]
    bad = {r["value"]: r["reject_reason"] for r in behaviour.rejected(parsed).collect()}
    assert bad == {"((3,4),1)": "arity", "": "blank", "((a,4,2.7),1)": "number"}


def test_profile_pages_are_bounded_and_whole(spark):
    df = spark.createDataFrame([(1, i, float(i)) for i in range(3000)], "user_id int, item_id int, score double")
    pages = behaviour.user_profile(df).collect()
    assert sorted(len(p["items"]) for p in pages) == [952, 1024, 1024]
    assert sorted(e["item_id"] for p in pages for e in p["items"]) == list(range(3000))


def test_split_is_repeatable_and_covers_all(spark):
    df = spark.createDataFrame([(u, i, 1.0) for u in range(40) for i in range(25)], "user_id int, item_id int, score double")
    once = behaviour.split_bucket(df)
    counts = {r["bucket"]: r["count"] for r in once.groupBy("bucket").count().collect()}
    assert sum(counts.values()) == 1000 and set(counts) == set(range(10))
    assert once.exceptAll(behaviour.split_bucket(df.repartition(5))).count() == 0
