"""Cells to a wide-column store, by client batches or by sorted files."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import islice
from typing import Protocol

from pyspark.sql import DataFrame, Row, SparkSession

from sorrel.operators.cells import sorted_cells


class CellClient(Protocol):
    def put(self, cells: list[Row]) -> None: ...

    def close(self) -> None: ...


def put_batches(cells: DataFrame, connect: Callable[[], CellClient], batch: int = 1000) -> None:
    """One client per partition; a failed put fails the task, and puts are repeatable."""

    def write(rows: Iterator[Row]) -> None:
        client = connect()
        try:
            while chunk := list(islice(rows, batch)):
                client.put(chunk)
        finally:
            client.close()

    cells.foreachPartition(write)


def write_direct(cells: DataFrame, path: str) -> None:
    """Cells through a file format, one folder per family."""
    cells.write.mode("append").partitionBy("family").parquet(path)


def write_bulk(cells: DataFrame, path: str, partitions: int | None = None) -> None:
    """Sorted files with separate key ranges, replacing whatever ``path`` held."""
    sorted_cells(cells, partitions).write.mode("overwrite").parquet(path)


def adopt(spark: SparkSession, table: str, path: str) -> None:
    """Makes the files a table unless it exists already, and picks up new files."""
    if not spark.catalog.tableExists(table):
        spark.catalog.createTable(table, path=path, source="parquet")
    spark.catalog.refreshTable(table)
