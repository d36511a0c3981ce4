"""Text, JSON and table scans with declared layouts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sorrel import schemas
from sorrel.functions.ip import ip_to_num
from sorrel.operators.behaviour import parse_messages
from sorrel.operators.ranges import range_fault

CORRUPT = "_corrupt"


def comma_table(spark: SparkSession, path: str, schema: StructType, trim: bool = True) -> DataFrame:
    """Comma-separated text; lines that do not fit the layout keep their text in ``_corrupt``."""
    flagged = StructType([*schema.fields, StructField(CORRUPT, StringType(), True)])
    return (
        spark.read.schema(flagged)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("ignoreLeadingWhiteSpace", trim)
        .option("ignoreTrailingWhiteSpace", trim)
        .csv(path)
    )


def items(spark: SparkSession, path: str, clustered: bool = False) -> DataFrame:
    return comma_table(spark, path, schemas.ITEM_CLUSTERED if clustered else schemas.ITEM_RAW)


def item_names(spark: SparkSession, path: str) -> DataFrame:
    return comma_table(spark, path, schemas.ITEM_NAME, trim=False)


def behaviours(spark: SparkSession, path: str) -> DataFrame:
    """Behaviour log, parsed; see ``behaviour.accepted`` and ``behaviour.rejected``."""
    return parse_messages(spark.read.text(path))


def pipe_fields(spark: SparkSession, path: str, picks: Mapping[str, int]) -> DataFrame:
    """Chosen positions of pipe-separated text as string columns; missing fields are null."""
    fields = F.split(F.col("value"), r"\|")
    return spark.read.text(path).select(*[F.get(fields, i).alias(name) for name, i in picks.items()])


def _range_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(line, start, end, location, reject_reason)``; a line without fault has no reason."""
    fields = F.split(F.col("value"), r"\|")
    label = F.concat_ws("-", *[F.coalesce(F.get(fields, i), F.lit("")) for i in (6, 7, 9, 13, 14)])
    number = lambda i: F.trim(F.get(fields, i)).try_cast("bigint")
    lines = spark.read.text(path).select(F.col("value").alias("line"), number(2).alias("start"), number(3).alias("end"), label.alias("location"))
    return lines.withColumn("reject_reason", range_fault(F.col("start"), F.col("end")))


def ip_ranges(spark: SparkSession, path: str) -> DataFrame:
    """``(start, end, location)`` from the IP table; the label joins five of its fields. See :func:`rejected_ip_ranges`."""
    return _range_lines(spark, path).where("reject_reason is null").select("start", "end", "location")


def rejected_ip_ranges(spark: SparkSession, path: str) -> DataFrame:
    """``(line, reject_reason)`` of the lines that :func:`ip_ranges` leaves out."""
    return _range_lines(spark, path).where("reject_reason is not null").select("line", "reject_reason")


def access_log(spark: SparkSession, path: str) -> DataFrame:
    """``(ip, ip_num)`` per line; ``ip_num`` is null where the address cannot be read."""
    return pipe_fields(spark, path, {"ip": 1}).withColumn("ip_num", ip_to_num(F.col("ip")))


def rejected_log_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(line, reject_reason)`` of the log lines without an address that can be read."""
    ip = F.get(F.split(F.col("value"), r"\|"), 1)
    reason = F.when(ip.isNull(), "arity").when(ip_to_num(ip).isNull(), "address")
    return spark.read.text(path).select(F.col("value").alias("line"), reason.alias("reject_reason")).where("reject_reason is not null")


def json_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.json(path)


def catalogue_table(spark: SparkSession, name: str, database: str | None = None) -> DataFrame:
    return spark.table(f"{database}.{name}" if database else name)
