"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sorrel.session import ensure_checkpoint_dir, shuffle_partitions

__all__ = ["WORD", "bound_rows", "crc_bucket", "n_words", "shared_path", "shuffle_partitions", "stored", "table"]

#: A word is a run of bytes other than these six separators.
WORD = r"[^\x20\x09-\x0D]+"
#: Held while a table is stored: finished shuffles leave no files, and texts reach Python in small batches.
STORING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession) -> str:
    """A new folder name below the checkpoint folder that driver and executors share."""
    return f"{ensure_checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it from there.

    Cuts the lineage like a checkpoint, in columns and compressed, so a lost executor
    costs a new read and not a new computation. The shuffle files of the finished write
    are of no further use and go at once. The table itself goes when the driver ends, as
    frames that read it may be in use until then.
    """
    spark = df.sparkSession
    path = shared_path(spark)
    before = {key: spark.conf.get(key) for key in STORING}
    for key, value in STORING.items():
        spark.conf.set(key, value)
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return spark.read.schema(df.schema).parquet(path)


def crc_bucket(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % n


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def bound_rows(batches: Iterator[pa.RecordBatch], column: str, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds about ``most`` bytes of ``column``, one row at least."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start = held = 0
        for i, size in enumerate(sizes):
            if i > start and held + size > most:
                yield batch.slice(start, i - start)
                start = i
                held = 0
            held += int(size)
        if start < batch.num_rows:
            yield batch.slice(start)
