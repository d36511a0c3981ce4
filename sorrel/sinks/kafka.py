"""Rows as Kafka records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def records(df: DataFrame, topic: str, value: Column, key: Column | None = None) -> DataFrame:
    """``(topic, key, value)`` with text contents; without a key the column is null."""
    return df.select(
        F.lit(topic).alias("topic"),
        (F.lit(None) if key is None else key).cast("string").alias("key"),
        value.cast("string").alias("value"),
    )


def send(frame: DataFrame, servers: str) -> None:
    frame.write.format("kafka").option("kafka.bootstrap.servers", servers).save()
