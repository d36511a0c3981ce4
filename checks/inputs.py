"""The test tables in the roles the operators expect."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sorrel.functions.ip import ip_to_num, num_to_ip
from sorrel.schemas import COLLECT, EVALUATE, VIEW

RANGE_BASE, RANGE_STEP = 16777216, 1024
#: Moves ids beyond 32 bits.
LARGE_ID = 3_000_000_000
OPERATIONS = {"view": VIEW, "click": COLLECT, "purchase": EVALUATE}
CHANGES = {"signup": "add", "error": "delete", "purchase": "update"}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def mapped(column: str, mapping: dict[str, str]):
    value = F.col(column)
    for old, new in mapping.items():
        value = F.when(F.col(column) == old, F.lit(new)).otherwise(value)
    return value


def events(spark: SparkSession, folder: str) -> DataFrame:
    """Events with the item number taken out of their JSON."""
    return table(spark, folder, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))


def behaviours(spark: SparkSession, folder: str) -> DataFrame:
    return events(spark, folder).select(
        F.col("user_id").cast("bigint").alias("user_id"), mapped("event_type", OPERATIONS).alias("operation"),
        F.col("k").cast("bigint").alias("item_id"),
    )


def messages(spark: SparkSession, folder: str) -> DataFrame:
    """Behaviour text in which some event types come out blank, short, with a trailing comma or with large ids."""
    u, k, kind = F.col("user_id").cast("string"), F.col("k").cast("string"), F.col("event_type")
    large = (F.col("user_id").cast("bigint") + LARGE_ID).cast("string")
    value = (
        F.when(kind == "view", F.concat_ws(",", u, F.lit(VIEW), k))
        .when(kind == "click", F.concat(u, F.lit(f",{COLLECT},"), k, F.lit(",")))
        .when(kind == "purchase", F.concat(F.lit(" "), large, F.lit(f",{EVALUATE},"), k, F.lit(" ")))
        .when(kind == "signup", F.lit("  "))
        .otherwise(F.concat(u, F.lit(f",{VIEW}")))
    )
    return events(spark, folder).select("event_id", value.alias("value"))


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings")


def access_log(spark: SparkSession, folder: str) -> DataFrame:
    number = F.lit(RANGE_BASE).cast("bigint") + F.col("event_id") * 11 + F.pmod("user_id", F.lit(7))
    log = table(spark, folder, "events").select("event_id", "event_type", num_to_ip(number).alias("ip"))
    return log.withColumn("ip_num", ip_to_num(F.col("ip")))


def ip_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """One range per supplier: gaps after most of them, overlaps after every fifth."""
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    start = F.lit(RANGE_BASE).cast("bigint") + F.col("s_suppkey") * RANGE_STEP
    label = F.concat_ws("-", "r_name", "n_name", "s_name", F.col("s_nationkey").cast("string"), F.col("n_regionkey").cast("string"))
    return (
        table(spark, folder, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            start.alias("start"),
            (start + 699 + F.pmod("s_suppkey", F.lit(5)) * 100).alias("end"),
            label.alias("location"),
        )
    )


def change_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Item change events as JSON text, in event order."""
    text = F.concat(
        F.lit('{"type": "'), mapped("event_type", CHANGES), F.lit('", "sid": '), F.col("k").cast("string"), F.lit("}")
    )
    return events(spark, folder).select("event_id", text.alias("value"))


def part_features(spark: SparkSession, folder: str) -> DataFrame:
    """Parts in the layout of the five-feature items; some have a fee that is no number."""
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("schoolid"),
        F.col("p_name").alias("schoolname"),
        F.col("p_size").alias("locationid"),
        F.length("p_type").alias("school_type"),
        F.col("p_retailprice").alias("zs"),
        F.when(F.col("p_partkey") % 11 == 0, "n/a").otherwise(F.regexp_extract("p_brand", r"#([0-9]+)", 1)).alias("fee"),
        F.length("p_name").alias("byj"),
    )


#: Statements of the error events, by the item number modulo their count.
ODD_STATEMENTS = (
    "select p_name from (select p_name from part where p_size > 3) t",
    "select count(*) as n, p_size from part group by p_size",
    "select l_quantity * l_extendedprice as gross from lineitem",
    "select r_name from region r, nation n",
    "select n_name from main.geo.nation",
    "with big as (select 1) select * from big",
    "select s_name from `supplier`",
    "select *, p_name from part where p_name = 'from nation, region'",
    "select p.p_name from part p join supplier using (p_size)",
    "select r.r_name, n_name from region r natural join nation",
    "select extract(year from l_shipdate) as y from lineitem",
    "select c_name from customer where c_mktsegment is distinct from c_name",
    "select s_name /* from part */ from supplier -- join nation\nwhere s_name <> '-- no comment'",
)


def query_log(spark: SparkSession, folder: str) -> DataFrame:
    """Statements over the test tables, one per event, some of kinds that are only flagged."""
    u, k, kind = F.col("user_id").cast("string"), F.col("k").cast("string"), F.col("event_type")
    odd = F.get(F.array(*map(F.lit, ODD_STATEMENTS)), F.pmod("k", F.lit(len(ODD_STATEMENTS))).cast("int"))
    text = (
        F.when(kind == "view", F.concat(
            F.lit("select p.p_brand, upper(p.p_type), s_name from part p inner join supplier as s "
                  "on p.p_size = s.s_nationkey where s.s_suppkey = "), u))
        .when(kind == "click", F.concat(F.lit("SELECT * FROM db"), k, F.lit(".region")))
        .when(kind == "purchase", F.concat(
            F.lit("select o.o_orderkey, sum(l_quantity) as qty from orders as o join lineitem l "
                  "on o.o_orderkey = l.l_orderkey where o.o_custkey = "), u, F.lit(" group by o.o_orderkey")))
        .when(kind == "signup", F.lit("select s_name\nfrom supplier;"))
        .otherwise(odd)
    )
    return events(spark, folder).select(F.col("event_id").alias("query_id"), text.alias("sql"))


def column_catalogue(spark: SparkSession, folder: str) -> DataFrame:
    names = ["customer", "nation", "region", "orders", "lineitem", "supplier", "part"]
    rows = [(name, field) for name in names for field in table(spark, folder, name).columns]
    return spark.createDataFrame(rows, "table string, column string")


def item_factors(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors in the role of item factors."""
    return vectors(spark, folder).select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("features")
    )


def user_factors(items: DataFrame, scores: DataFrame) -> DataFrame:
    """Means of the factors of a user's items, weighted by score; they stand for fitted ones."""
    rated = scores.where("score > 0").join(items.withColumnRenamed("id", "item_id"), "item_id")
    mean = Summarizer.mean(array_to_vector("features"), F.col("score"))
    return rated.groupBy("user_id").agg(mean.alias("_m")).select(
        F.col("user_id").alias("id"), vector_to_array("_m").alias("features")
    )
