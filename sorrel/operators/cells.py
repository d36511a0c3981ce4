"""Rows as wide-column cells ``(rowkey, family, qualifier, value)``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sorrel.schemas import CELL_FAMILY
from sorrel.session import shuffle_partitions


def to_cells(df: DataFrame, key: str, family: str = CELL_FAMILY) -> DataFrame:
    """One cell per non-null column other than ``key``."""
    columns = sorted(c for c in df.columns if c != key)
    text = df.select(F.col(key).cast("string").alias("rowkey"), *[F.col(c).cast("string").alias(c) for c in columns])
    return (
        text.unpivot(["rowkey"], columns, "qualifier", "value")
        .where("rowkey is not null and value is not null")
        .select("rowkey", F.lit(family).alias("family"), "qualifier", "value")
    )


def as_bytes(cells: DataFrame) -> DataFrame:
    return cells.select(*[F.encode(F.col(c), "UTF-8").alias(c) for c in cells.columns])


def sorted_cells(cells: DataFrame, partitions: int | None = None) -> DataFrame:
    """Range partitions in key order, each sorted: files written from it do not overlap."""
    order = ["rowkey", "qualifier"]
    parts = partitions or shuffle_partitions(cells.sparkSession)
    return cells.repartitionByRange(parts, *order).sortWithinPartitions(*order)
