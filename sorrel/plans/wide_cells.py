"""JSON rows to wide-column cells, by any of the three writers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from sorrel.operators.cells import as_bytes, to_cells
from sorrel.sinks import cells as sink
from sorrel.sources.files import json_table


def json_cells(spark: SparkSession, path: str, key: str = "id", schema: StructType | None = None) -> DataFrame:
    return to_cells(json_table(spark, path, schema), key)


def put(spark: SparkSession, path: str, connect: Callable[[], sink.CellClient], batch: int = 1000) -> None:
    sink.put_batches(as_bytes(json_cells(spark, path)), connect, batch)


def bulk_load(spark: SparkSession, path: str, target: str, table: str) -> None:
    """Writes sorted files and makes them available as a table."""
    sink.write_bulk(json_cells(spark, path), target)
    sink.adopt(spark, table, target)
