"""Record layouts and fixed values shared by the readers and jobs."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# Words, weights, key prefixes and counts the results depend on.
VIEW, COLLECT, EVALUATE = "浏览", "收藏", "评价"
OFFLINE_WEIGHTS = {VIEW: 1.15, COLLECT: 1.55, EVALUATE: 1.30}
STREAM_WEIGHTS = {VIEW: 0.15, COLLECT: 0.55, EVALUATE: 0.30}
OFFLINE_CB = "recom:offlineCB:"
ONLINE_CB = "recom:onlineCB:"
OFFLINE_ALS = "recom:offlineALS:"
ONLINE_ALS = "recom:realALS:"
SIMILAR_PER_ITEM = 6
UNSEEN_PER_USER = 7
NEAREST_IN_CLUSTER = 3
TTL_DAYS = 7
ALS_RANKS, ALS_ITERATIONS, ALS_LAMBDAS = (10, 12), (10, 20), (0.6, 10.0)
KMEANS_K, KMEANS_ITERATIONS = (3, 6, 9), (10, 15, 20)
CELL_FAMILY = "hfile-fy"
FEATURES = ["locationid", "school_type", "zs", "fee", "byj"]
STREAM_SECONDS_DIRECT, STREAM_SECONDS_RECEIVER = 5, 25
STREAM_RATE_PER_PARTITION = 5
STREAM_PARTITIONS = 8
JDBC_BATCH = 1000


def _struct(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields])


_S, _I, _L, _D = StringType(), IntegerType(), LongType(), DoubleType()

ITEM_RAW = _struct(
    ("schoolid", _L), ("schoolname", _S), ("location", _S), ("locationid", _D),
    ("school_type", _D), ("zs", _D), ("fee", _D), ("byj", _D),
)
ITEM_CLUSTERED = StructType(ITEM_RAW.fields + [StructField("prediction", _I, True)])
BEHAVIOUR = _struct(("user_id", _S), ("operation", _S), ("item_id", _S))
ITEM_NAME = _struct(("item_id", _I), ("name", _S))
PEOPLE = _struct(("id", _S), ("name", _S), ("age", _S))
STATS = _struct(("id", _S), ("url", _S), ("pv", _L), ("uv", _L))
CHANGE_EVENT = _struct(("type", _S), ("sid", _L))
