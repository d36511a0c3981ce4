import math

import pytest
from pyspark.sql import functions as F

from sorrel.functions import similarity
from sorrel.functions.ip import ip_to_num, num_to_ip
from sorrel.functions.lists import decode_ids, decode_scored, encode_ids, encode_scored


def value(spark, name, a, b, **kw):
    df = spark.createDataFrame([(a, b)], "a array<double>, b array<double>")
    return df.select(similarity.METRICS[name](F.col("a"), F.col("b"), **kw)).head()[0]


@pytest.mark.parametrize(
    "name, a, b, wanted",
    [
        ("cosine", [1.0, 0.0], [0.0, 2.0], 0.0),
        ("cosine", [1.0, 2.0], [2.0, 4.0], 1.0),
        ("cosine", [3.0, 4.0], [4.0, 3.0], 0.96),
        ("pearson", [1.0, 2.0, 3.0], [2.0, 4.0, 6.0], 1.0),
        ("pearson", [1.0, 2.0, 3.0], [3.0, 2.0, 1.0], -1.0),
        ("euclidean", [0.0, 0.0], [3.0, 4.0], 5.0),
        ("euclidean", [1.0, 1.0], [1.0, 1.0], 0.0),
        # Common mean 2.5: (-1.5, -0.5) and (0.5, 1.5).
        ("adjusted_cosine", [1.0, 2.0], [3.0, 4.0], -0.6),
    ],
)
def test_known_values(spark, name, a, b, wanted):
    assert value(spark, name, a, b) == pytest.approx(wanted, abs=1e-12)


@pytest.mark.parametrize(
    "name, a, b",
    [
        ("cosine", [0.0, 0.0], [1.0, 2.0]),
        ("pearson", [5.0, 5.0], [1.0, 2.0]),
        ("adjusted_cosine", [2.0, 2.0], [2.0, 2.0]),
        ("cosine", [], []),
        ("pearson", [], []),
    ],
)
def test_zero_denominator_is_nan(spark, name, a, b):
    assert math.isnan(value(spark, name, a, b))


@pytest.mark.parametrize("name", sorted(similarity.METRICS))
def test_length_check(spark, name):
    assert value(spark, name, [1.0, 2.0], [1.0], on_mismatch="null") is None
    with pytest.raises(Exception, match="vectors differ in length: 2 and 1"):
        value(spark, name, [1.0, 2.0], [1.0])


@pytest.mark.parametrize("name", sorted(similarity.METRICS))
def test_symmetry(spark, name):
    a, b = [1.0, -2.0, 0.5], [0.25, 4.0, -1.0]
    assert value(spark, name, a, b) == pytest.approx(value(spark, name, b, a), abs=1e-12)


@pytest.mark.parametrize(
    "text, number",
    [
        ("1.86.64.0", 22429696), ("0.0.0.0", 0), ("255.255.255.255", 4294967295), (" 1.2.3.4 ", 16909060),
        ("001.002.003.004", 16909060), ("256.1.1.1", None), ("1.2.3", None), ("1.2.3.4.5", None), ("a.b.c.d", None),
        ("1..2.3", None), ("", None), (None, None), ("-1.2.3.4", None), ("1.2.3.0004", None),
    ],
)
def test_ip_to_num(spark, text, number):
    df = spark.createDataFrame([(text,)], "ip string")
    assert df.select(ip_to_num(F.col("ip"))).head()[0] == number


def test_num_to_ip(spark):
    df = spark.createDataFrame([(22429696,), (4294967295,)], "n bigint")
    assert [r[0] for r in df.select(num_to_ip(F.col("n"))).collect()] == ["1.86.64.0", "255.255.255.255"]


def test_lists_round_trip(spark):
    lists = [[], [(1, 0.5)], [(7, 1.0e-4), (3, 0.25), (9, -1.5e-7)]]
    df = spark.createDataFrame([(x,) for x in lists], "entries array<struct<item:bigint,sim:double>>")
    back = df.select(decode_scored(encode_scored(F.col("entries"))).alias("e")).collect()
    assert [[tuple(e) for e in r.e] for r in back] == lists


def test_decode_drops_what_does_not_parse(spark):
    df = spark.createDataFrame([("1:0.5,,x:1,2,3:1.0E-4",)], "t string")
    assert [tuple(e) for e in df.select(decode_scored(F.col("t"))).head()[0]] == [(1, 0.5), (3, 1.0e-4)]


def test_ids_round_trip(spark):
    df = spark.createDataFrame([([3, 1, 2],)], "ids array<bigint>")
    assert df.select(encode_ids(F.col("ids"))).head()[0] == "3,1,2"
    assert df.select(decode_ids(encode_ids(F.col("ids")))).head()[0] == [3, 1, 2]
