"""Access log and IP table to rows per location."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sorrel.operators.ranges import location_counts
from sorrel.sinks.jdbc import appender, location_rows
from sorrel.sources.files import access_log, ip_ranges


def count_locations(spark: SparkSession, log_path: str, ranges_path: str, unmatched: bool = False) -> DataFrame:
    return location_counts(access_log(spark, log_path), ip_ranges(spark, ranges_path), "ip_num", unmatched)


def store_locations(counts: DataFrame, url: str, table: str, **properties: str) -> None:
    appender(location_rows(counts), url, table, **properties).save()
