"""The serving table as files: a change log by batch, compacted from time to time.

A compaction writes a new version below the table's folder and then moves the pointer, a
small text table of version numbers, to it. Readers and writers look the pointer up each
time, so that they follow without being told; a reader that has started goes on with the
version it began with. One writer at a time is assumed.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sorrel.operators.joins import at_most
from sorrel.operators.serving import COLUMNS, latest, live
from sorrel.session import materialise, shuffle_partitions

IN_LIST_KEYS = 1000
LAYOUT = (
    "namespace string, key string, page bigint, value string, expires_at timestamp, "
    "deleted boolean, written_at timestamp, seq bigint"
)


def current_folder(spark: SparkSession, path: str) -> str:
    """Where the table's current version lies; the table's own folder before the first compaction."""
    try:
        newest = spark.read.schema("value string").text(f"{path}/_pointer").agg(F.max(F.col("value").cast("int"))).head()[0]
    except AnalysisException:  # there is no pointer yet
        newest = None
    return path if newest is None else f"{path}/_versions/{newest}"


def append_batch(changes: DataFrame, path: str, batch_id: int) -> None:
    """Adds one batch; running the same batch again replaces it instead of doubling it."""
    _write_batch(changes, current_folder(changes.sparkSession, path), batch_id)


def _write_batch(changes: DataFrame, folder: str, batch_id: int) -> None:
    (
        changes.select(*COLUMNS)
        .withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(folder)
    )


def read_changes(spark: SparkSession, path: str) -> DataFrame:
    return _batches(spark, path).select(*COLUMNS)


def _batches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{LAYOUT}, batch_id bigint").parquet(current_folder(spark, path))


def changes_of(changes: DataFrame, namespace: str, keys: DataFrame) -> DataFrame:
    """The changes of some keys of a namespace, for looking up what one batch needs.

    Few keys become an IN filter, which skips the parts of sorted files that hold none
    of them; many keys are joined.
    """
    wanted = changes.where(F.col("namespace") == namespace)
    keys = keys.select("key").where(F.col("key").isNotNull()).distinct().persist()
    try:
        if at_most(keys, IN_LIST_KEYS):
            return wanted.where(F.col("key").isin([r["key"] for r in keys.collect()]))
        return wanted.join(keys, "key", "left_semi").select(*COLUMNS)
    finally:
        keys.unpersist()


def read_live(spark: SparkSession, path: str, now: Column) -> DataFrame:
    return live(latest(read_changes(spark, path)), now)


def compact(spark: SparkSession, path: str, target: str, now: Column) -> None:
    """Writes the live state as a table of its own, in key order."""
    _write_batch(_in_key_order(materialise(read_live(spark, path, now))), target, 0)


def _in_key_order(state: DataFrame) -> DataFrame:
    order = ["namespace", "key", "page"]
    return state.repartitionByRange(shuffle_partitions(state.sparkSession), *order).sortWithinPartitions(*order)


def compact_version(spark: SparkSession, path: str, now: Column) -> None:
    """Folds all batches but the newest into one sorted batch and moves the table to that version.

    The newest batch stays as it is: a stream may run it again, and has to find the state before it.
    """
    batches = materialise(_batches(spark, path))
    newest = batches.agg(F.max("batch_id")).head()[0]
    if newest is None:
        return
    here = current_folder(spark, path)
    number = 1 if here == path else int(here.rsplit("/", 1)[1]) + 1
    folder = f"{path}/_versions/{number}"
    state = live(latest(batches.where(F.col("batch_id") < newest).select(*COLUMNS)), now)
    _write_batch(_in_key_order(materialise(state)), folder, newest - 1)
    _write_batch(batches.where(F.col("batch_id") == newest), folder, newest)
    spark.createDataFrame([(str(number),)], "value string").coalesce(1).write.mode("append").text(f"{path}/_pointer")
