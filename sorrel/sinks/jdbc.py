"""Batched appends to relational tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql import functions as F

from sorrel.schemas import JDBC_BATCH


def appender(df: DataFrame, url: str, table: str, batch: int = JDBC_BATCH, connections: int = 8, **properties: str) -> DataFrameWriter:
    """A writer that appends in batches of ``batch`` rows over at most ``connections`` connections."""
    options = {"url": url, "dbtable": table, "batchsize": str(batch), "numPartitions": str(connections), **properties}
    return df.write.format("jdbc").options(**options).mode("append")


def location_rows(counts: DataFrame) -> DataFrame:
    return counts.select("location", F.col("ip_count").cast("bigint"))


def cluster_rows(assigned: DataFrame, id_col: str, name_col: str) -> DataFrame:
    """``(schoolid, name, prediction, accesse_date)`` rows dated today."""
    return assigned.select(
        F.col(id_col).alias("schoolid"),
        F.col(name_col).alias("name"),
        F.col("cluster").alias("prediction"),
        F.current_date().alias("accesse_date"),
    )
