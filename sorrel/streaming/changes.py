"""Upkeep of the similar-item lists from a stream of item changes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sorrel.functions.lists import decode_scored, encode_scored
from sorrel.operators.serving import deletes, latest, lookup, puts
from sorrel.operators.similar_lists import apply_changes, latest_changes
from sorrel.schemas import OFFLINE_CB, SIMILAR_PER_ITEM
from sorrel.session import materialise
from sorrel.sinks.list_store import ListStore, Touched
from sorrel.sinks.serving import append_batch, read_changes


def stored_lists(state: DataFrame) -> DataFrame:
    return lookup(state, OFFLINE_CB, F.current_timestamp()).select(
        F.col("key").cast("bigint").alias("base"), decode_scored(F.col("value")).alias("entries")
    )


def list_changes(before: DataFrame, after: DataFrame, batch_id: int) -> DataFrame:
    """Serving-table changes that turn ``before`` into ``after``; equal lists write nothing."""
    old = before.select("base", encode_scored(F.col("entries")).alias("_old"))
    new = after.select("base", encode_scored(F.col("entries")).alias("_new"))
    both = old.join(new, "base", "full")
    stamp, seq = F.current_timestamp(), F.lit(batch_id)
    written = both.where(F.col("_new").isNotNull() & ~F.col("_new").eqNullSafe(F.col("_old")))
    gone = both.where(F.col("_new").isNull())
    return puts(written, OFFLINE_CB, F.col("base"), F.col("_new"), stamp, seq).unionByName(
        deletes(gone, OFFLINE_CB, F.col("base"), stamp, seq)
    )


def batch_writer(
    lists_path: str,
    read_catalogue: Callable[[SparkSession], DataFrame],
    id_col: str,
    vec_col: str,
    n: int = SIMILAR_PER_ITEM,
) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function; the catalogue is read anew for every batch.

    Batch 0 of the table holds the prepared lists, so a stream batch ``b`` is stored
    as ``b + 1``; a repeat starts again from the state before it.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        spark = batch.sparkSession
        # Lines of one file stay in order; across files and partitions the arrival decides.
        ordered = batch.withColumn("_order", F.struct("sequence", F.monotonically_increasing_id().alias("line")))
        changes = latest_changes(ordered, "_order")
        earlier = read_changes(spark, lists_path).where(F.col("seq") <= batch_id)
        before = materialise(stored_lists(latest(earlier)))
        after = apply_changes(before, changes, read_catalogue(spark), id_col, vec_col, n)
        append_batch(materialise(list_changes(before, after, batch_id + 1)), lists_path, batch_id + 1)

    return write


def block_writer(
    store: ListStore,
    lists_path: str,
    read_catalogue: Callable[[SparkSession], DataFrame],
    id_col: str,
    vec_col: str,
    touched: list[Touched] | None = None,
) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function over a list store: a batch reads and writes only blocks that it can alter.

    The serving table at ``lists_path`` gets the lists that came out different. ``touched`` gets what each batch
    read and wrote.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        ordered = batch.withColumn("_order", F.struct("sequence", F.monotonically_increasing_id().alias("line")))
        changes = materialise(latest_changes(ordered, "_order"))
        before, after, what = store.apply(changes, read_catalogue(batch.sparkSession), id_col, vec_col, batch_id + 1)
        append_batch(materialise(list_changes(before, after, batch_id + 1)), lists_path, batch_id + 1)
        if touched is not None:
            touched.append(what)

    return write
