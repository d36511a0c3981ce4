"""Numbering rows of a total order without putting a group into one task.

Rows are range-partitioned and sorted once, then stored together with their place in the
partition, so that a repeated task cannot see other range bounds. What a partition has to
know of the others is one row per partition, and that is all that leaves the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from sorrel.operators.joins import lookup_join
from sorrel.session import materialise, shuffle_partitions

_PLACE = (1 << 33) - 1


def _sorted(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    parts = shuffle_partitions(df.sparkSession)
    return (
        df.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
    )


def global_index(df: DataFrame, order: Sequence[Column], name: str = "index") -> DataFrame:
    """Consecutive numbers from 0 along ``order``."""
    placed = materialise(_sorted(df, order))
    placed = placed.withColumn("_part", F.shiftright("_place", 33))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part").count().select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_place").bitwiseAND(F.lit(_PLACE)))
        .drop("_part", "_place", "_offset")
    )


def _with_run_starts(key: str):
    """Adds the place, within the partition, at which the run of the row's key begins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, start, last = 0, 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(key)
            after, before = keys.slice(1), keys.slice(0, len(keys) - 1)
            same = pc.or_(pc.fill_null(pc.equal(after, before), False), pc.and_(pc.is_null(after), pc.is_null(before)))
            head = at > 0 and (keys[0].equals(last) or not (keys[0].is_valid or last.is_valid))
            fresh = pa.concat_arrays([pa.array([not head]), pc.invert(same)])
            places = pa.array(np.arange(at, at + len(keys), dtype=np.int64))
            starts = pc.fill_null(pc.fill_null_forward(pc.if_else(fresh, places, pa.scalar(None, pa.int64()))), start)
            yield pa.RecordBatch.from_arrays([*batch.columns, starts], names=[*batch.schema.names, "_start"])
            at, start, last = at + len(keys), starts[-1].as_py(), keys[-1]

    return run


def rank_within(df: DataFrame, key: str, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """Rank from 1 inside each ``key`` along ``order``, however large one key is.

    Within a partition the rank is the distance from the start of the key's run. Only the
    run at the head of a partition can go on from partitions before it.
    """
    placed = _sorted(df, [F.col(key), *order])
    schema = StructType([*placed.schema.fields, StructField("_start", LongType())])
    placed = materialise(placed.mapInArrow(_with_run_starts(key), schema))
    placed = placed.withColumns({
        "_part": F.shiftright("_place", 33), "_local": F.col("_place").bitwiseAND(F.lit(_PLACE)),
    })
    ends = placed.groupBy("_part").agg(
        F.count(F.lit(1)).alias("rows"), F.max("_start").alias("last_start"),
        F.min_by(key, "_local").alias("first_key"), F.max_by(key, "_local").alias("last_key"),
    )
    carried, going, open_rows = [], None, 0
    for r in ends.orderBy("_part").collect():  # one row per partition
        carry = open_rows if going is not None and r["first_key"] == going[0] else 0
        carried.append(Row(_part=r["_part"], _carry=carry))
        open_rows = r["rows"] - r["last_start"] + (carry if r["last_start"] == 0 else 0)
        going = (r["last_key"],)
    carries = df.sparkSession.createDataFrame(carried, "_part bigint, _carry bigint")
    head = F.when(F.col("_start") == 0, F.col("_carry")).otherwise(0)
    return (
        placed.join(F.broadcast(carries), "_part")
        .withColumn(name, F.col("_local") - F.col("_start") + 1 + head)
        .drop("_part", "_place", "_local", "_start", "_carry")
    )


def _gaps_of_runs(total: int):
    """Gaps between the rows of a partition, and its first and last row with ``edge`` 1 and 2."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, places = batch.column(0), batch.column(1)
            if last is None:
                yield _rows(keys.slice(0, 1), places.slice(0, 1), places.slice(0, 1), 1)
            else:
                keys, places = pa.concat_arrays([last[0], keys]), pa.concat_arrays([last[1], places])
            here, there = keys.slice(0, len(keys) - 1), keys.slice(1)
            before, after = places.slice(0, len(places) - 1), places.slice(1)
            same = pc.fill_null(pc.equal(here, there), False)
            other = pc.invert(same)
            yield _rows(here.filter(same), pc.add(before.filter(same), 1), pc.subtract(after.filter(same), 1), 0)
            yield _rows(here.filter(other), pc.add(before.filter(other), 1), _all(total - 1, here.filter(other)), 0)
            yield _rows(there.filter(other), _all(0, there.filter(other)), pc.subtract(after.filter(other), 1), 0)
            last = keys.slice(len(keys) - 1), places.slice(len(places) - 1)
        if last is not None:
            yield _rows(last[0], last[1], last[1], 2)

    return run


def _all(value: int, like: pa.Array) -> pa.Array:
    return pa.array(np.full(len(like), value, dtype=np.int64))


def _rows(keys: pa.Array, first: pa.Array, last: pa.Array, edge: int) -> pa.RecordBatch:
    edges = pa.array([edge] * len(keys), pa.int32())
    return pa.RecordBatch.from_arrays([keys, first, last, edges], names=["key", "first", "last", "edge"])


def neighbour_gaps(df: DataFrame, key: str, position: str, total: int) -> DataFrame:
    """Stretches of ``0 .. total-1`` not covered by ``position``, per ``key``; null keys drop out.

    Neighbours lie next to each other in a partition; only the first and the last row of
    each partition, two rows per partition, meet those of the others.
    """
    narrow = df.where(F.col(key).isNotNull()).select(key, F.col(position).cast("bigint").alias(position))
    parts = shuffle_partitions(df.sparkSession)
    ordered = narrow.repartitionByRange(parts, key, position).sortWithinPartitions(key, position)
    kind = narrow.schema[key].dataType.simpleString()
    shape = f"key {kind}, first bigint, last bigint, edge int"
    found = materialise(ordered.mapInArrow(_gaps_of_runs(total), shape).where("edge > 0 or first <= last"))
    edges = sorted(found.where("edge > 0").select("key", "first", "edge").collect(), key=lambda r: (r["key"], r["first"], r["edge"]))
    # Sorted, the edges run first, last, first, last, ... from partition to partition.
    seams = []
    inner = [None, *edges, None]
    for one, two in zip(inner[::2], inner[1::2]):
        if one is not None and two is not None and one["key"] == two["key"]:
            seams.append((one["key"], one["first"] + 1, two["first"] - 1))
            continue
        if one is not None:
            seams.append((one["key"], one["first"] + 1, total - 1))
        if two is not None:
            seams.append((two["key"], 0, two["first"] - 1))
    between = df.sparkSession.createDataFrame(seams, f"key {kind}, first bigint, last bigint")
    whole = found.where("edge = 0").select("key", "first", "last").union(between).where("first <= last")
    return whole.select(F.col("key").alias(key), "first", "last")


def unseen_stretches(behaviours: DataFrame, catalogue: DataFrame, user: str = "user_id", item: str = "item_id") -> DataFrame:
    """Stretches of catalogue positions (items in id order) that a user has not touched.

    Every user of ``behaviours`` counts, also one whose items are all outside the catalogue:
    that user gets the whole catalogue.
    """
    placed = materialise(global_index(catalogue.select(item).where(F.col(item).isNotNull()).distinct(), [F.col(item)], "position"))
    total = placed.count()
    pairs = materialise(behaviours.select(user, item).where(F.col(user).isNotNull()).distinct())
    seen = materialise(lookup_join(pairs, placed, [item], [user]))
    users = pairs.select(user).distinct().join(seen.select(user).distinct(), user, "left_anti")
    whole = users.select(user, F.lit(0).cast("bigint").alias("first"), F.lit(total - 1).cast("bigint").alias("last"))
    return neighbour_gaps(seen, user, "position", total).unionByName(whole.where("first <= last"))
