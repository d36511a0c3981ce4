"""Similar-item lists as files that a change touches only where it can matter.

The lists lie in blocks of neighbouring items, as ``operators/pruned`` makes them, with the items'
unit vectors. ``meta`` has a row per block: its distances from its pivot, and the least k-th score
of its lists. ``reverse`` says in which blocks an item is listed or has its own list. A changed item can
alter a list only if

* the list holds it, or is its own: ``reverse`` names these blocks;
* or it may now enter the list: then some member of the block can be so close to it that the least
  k-th score of the block is reached, which the triangle inequality tells from ``meta``.

All other blocks are neither read nor written. A block is written whole, as ``block=b/batch=k``; a reader
takes the newest batch of each block, and a batch that is run again starts from the batches before it and
overwrites its own files, so that nothing happens twice.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sorrel.operators import similar_lists
from sorrel.operators.pruned import BLOCK_ROWS, Bounds, _ready, build_index, distances
from sorrel.operators.topk import _vectors
from sorrel.schemas import SIMILAR_PER_ITEM
from sorrel.session import materialise

#: Changed items of a batch up to which blocks are singled out; beyond, all are read.
FEW_CHANGES = 10_000
BUCKETS = 256
#: The block of items without a direction, which are in no list and have none.
NOWHERE = -1
LISTS = "base bigint, vec array<double>, entries array<struct<item:bigint,sim:double>>"
META = "block int, cell bigint, low double, high double, least double, size bigint, batch bigint"


@dataclass
class Touched:
    """What a batch read and wrote."""

    blocks_read: list[int]
    lists_read: int
    blocks_written: list[int]
    lists_written: int


class ListStore:
    """The store below a folder, for lists of ``n`` entries by cosine."""

    def __init__(self, spark: SparkSession, path: str, n: int = SIMILAR_PER_ITEM):
        self.spark, self.path, self.n = spark, path, n

    def create(self, catalogue: DataFrame, id_col: str, vec_col: str, block_rows: int = BLOCK_ROWS) -> None:
        """Builds all lists and stores them as batch 0."""
        ready = materialise(_ready(catalogue, "cosine", id_col, vec_col, None))
        index = build_index(ready, "cosine", False, block_rows)
        if index is None:
            raise ValueError("no item has a direction, or there are too many blocks for one index")
        rows, bounds, _ = index
        pivots = list(enumerate(bounds.pivots.tolist()))
        self.spark.createDataFrame(pivots, "cell bigint, vec array<double>").write.mode("overwrite").parquet(f"{self.path}/pivots")
        lists = similar_lists.build(catalogue, id_col, vec_col, self.n)
        placed = lists.join(rows.select(F.col("id").alias("base"), "vec", "block"), "base", "left")
        cells = self.spark.createDataFrame([(NOWHERE, -1), *enumerate(bounds.cells.tolist())], "block int, cell bigint")
        self._write(materialise(placed.withColumn("block", F.coalesce("block", F.lit(NOWHERE)))), cells, bounds.pivots, 0)

    def lists(self, before: int | None = None) -> DataFrame:
        """All lists as they are, or as they were before a batch."""
        return self._blocks(self._meta(before)).select("base", "entries")

    def _meta(self, before: int | None) -> list[dict]:
        """The newest row of each block; one short row per block."""
        meta = self.spark.read.schema(META).parquet(f"{self.path}/meta")
        if before is not None:
            meta = meta.where(F.col("batch") < before)
        newest = meta.groupBy("block").agg(F.max_by(F.struct("cell", "low", "high", "least", "size", "batch"), "batch").alias("m"))
        return [r.asDict() for r in newest.select("block", "m.*").orderBy("block").collect()]

    def _blocks(self, meta: list[dict]) -> DataFrame:
        paths = [f"{self.path}/lists/block={m['block']}/batch={m['batch']}" for m in meta if m["size"]]
        if not paths:
            return self.spark.createDataFrame([], f"{LISTS}, block int")
        read = self.spark.read.schema(f"{LISTS}, block int").option("basePath", f"{self.path}/lists").parquet(*paths)
        return read.select("base", "vec", "entries", "block")

    def _write(self, lists: DataFrame, cells: DataFrame, pivots: np.ndarray, batch: int, emptied: list[int] = ()) -> None:
        """The lists of whole blocks, ``(base, vec, entries, block)``, as one batch."""
        pivot = self.spark.createDataFrame(list(enumerate(pivots.tolist())), "cell bigint, _pivot array<double>")
        known = lists.join(F.broadcast(cells), "block").join(F.broadcast(pivot), "cell", "left")
        squares = F.aggregate(F.zip_with("vec", "_pivot", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)
        last = F.when(F.size("entries") == self.n, F.round(F.element_at("entries", -1)["sim"], 10)).otherwise(-2.0)
        meta = known.groupBy("block", "cell").agg(
            F.min(F.sqrt(squares)).alias("low"), F.max(F.sqrt(squares)).alias("high"), F.min(last).alias("least"),
            F.count(F.lit(1)).alias("size"),
        )
        gone = cells.where(F.col("block").isin(list(emptied))).select(
            "block", "cell", *[F.lit(None).cast("double").alias(c) for c in ("low", "high", "least")], F.lit(0).cast("bigint").alias("size")
        )
        listed = lists.select("block", F.explode(F.array_union(F.array("base"), F.col("entries.item"))).alias("item")).distinct()
        listed = listed.withColumn("bucket", F.pmod(F.xxhash64("item"), F.lit(BUCKETS)).cast("int"))

        def store(df: DataFrame, name: str, *by: str) -> None:
            df = df.withColumn("batch", F.lit(batch).cast("bigint"))
            writer = df.repartition(*by).write if by else df.coalesce(1).write
            writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by, "batch").parquet(f"{self.path}/{name}")

        store(lists, "lists", "block")
        store(listed, "reverse", "bucket")
        # Last, as it makes the batch visible.
        store(meta.unionByName(gone), "meta")

    def _listed_in(self, ids: list[int], before: int) -> set[int]:
        """Blocks that list one of the items or hold its own list; perhaps some that no longer do."""
        if not ids:
            return set()
        frame = self.spark.createDataFrame([(i,) for i in ids], "item bigint")
        buckets = [r[0] for r in frame.select(F.pmod(F.xxhash64("item"), F.lit(BUCKETS)).cast("int")).distinct().collect()]
        try:
            reverse = self.spark.read.schema("block int, item bigint, bucket int, batch bigint").parquet(f"{self.path}/reverse")
        except AnalysisException:  # no list holds anything
            return set()
        found = reverse.where(F.col("bucket").isin(buckets) & (F.col("batch") < before)).join(F.broadcast(frame), "item", "left_semi")
        return {r["block"] for r in found.select("block").distinct().collect()}

    def apply(self, changes: DataFrame, catalogue: DataFrame, id_col: str, vec_col: str, batch: int) -> tuple[DataFrame, DataFrame, Touched]:
        """One batch ``(sid, type)`` with at most one change per item; ``batch`` counts from 1.

        Returns the lists read, as they were and as they are, and what was touched.
        """
        rows = changes.select(F.col("sid").cast("bigint").alias("sid"), "type").limit(FEW_CHANGES + 1).collect()
        meta, pivots = self._meta(batch), _vectors(self.spark.read.parquet(f"{self.path}/pivots").orderBy("cell").toArrow())
        ids = [r["sid"] for r in rows]
        fresh = [r["sid"] for r in rows if r["type"] != "delete"]
        if len(rows) > FEW_CHANGES:
            moved = _ready(catalogue.join(changes.where("type <> 'delete'").select(F.col("sid").alias(id_col)), id_col, "left_semi"),
                           "cosine", id_col, vec_col, None)
            wanted = {m["block"] for m in meta}
        else:
            moved = _ready(catalogue.where(F.col(id_col).isin(fresh)), "cosine", id_col, vec_col, None)
            wanted = self._listed_in(ids, batch)
        moved = materialise(moved)
        homes = self._homes(moved, meta, pivots)
        if len(rows) <= FEW_CHANGES:
            wanted |= self._may_admit(moved, meta, pivots) | set(homes.values())
        part = [m for m in meta if m["block"] in wanted]
        before = materialise(self._blocks(part))
        after = similar_lists.apply_changes(before.select("base", "entries"), changes, catalogue, id_col, vec_col, self.n)
        # A changed item moves to the block that its vector is nearest to; the others stay where they are.
        placed = self.spark.createDataFrame(list(homes.items()), "base bigint, _home int")
        directions = moved.select(F.col("id").alias("base"), F.col("vec").alias("_new")).join(placed, "base")
        changed = changes.where("type <> 'delete'").select(F.col("sid").cast("bigint").alias("base"), F.lit(True).alias("_changed"))
        after = after.join(before.select("base", "vec", "block"), "base", "left").join(directions, "base", "left").join(changed, "base", "left")
        after = materialise(after.select(
            "base", "entries", F.when(F.col("_changed"), F.col("_new")).otherwise(F.col("vec")).alias("vec"),
            F.when(F.col("_changed"), F.coalesce("_home", F.lit(NOWHERE))).otherwise(F.col("block")).alias("block"),
        ))
        old, new = before.select("base", "block", "vec", "entries"), after.select("base", "block", "vec", "entries")
        differ = old.exceptAll(new).select("block").union(new.exceptAll(old).select("block")).distinct()
        blocks = sorted(r["block"] for r in differ.collect())
        written = after.where(F.col("block").isin(blocks))
        left = {r["block"] for r in written.select("block").distinct().collect()}
        cells = self.spark.createDataFrame(
            [(m["block"], m["cell"]) for m in meta] + ([(NOWHERE, -1)] if all(m["block"] != NOWHERE for m in meta) else []), "block int, cell bigint"
        )
        self._write(written.select("base", "vec", "entries", "block"), cells, pivots, batch, [b for b in blocks if b not in left])
        touched = Touched([m["block"] for m in part], before.count(), blocks, written.count())
        return before.select("base", "entries"), after.select("base", "entries"), touched

    @staticmethod
    def _homes(moved: DataFrame, meta: list[dict], pivots: np.ndarray) -> dict[int, int]:
        """For each changed item the block of the nearest pivot whose distances are nearest to its own."""
        table = moved.toArrow()  # the changed items of one batch
        used = [m for m in meta if m["block"] != NOWHERE]
        if not table.num_rows or not used:
            return {}
        vectors = _vectors(table)
        cells = np.array([m["cell"] for m in used])
        low, high = (np.array([np.nan if m[c] is None else m[c] for m in used]) for c in ("low", "high"))
        away = distances(vectors, pivots)
        # A cell whose blocks are all empty still has them.
        off = np.where(np.isnan(low), 0.0, np.maximum(np.maximum(low - away[:, cells], away[:, cells] - high), 0))
        known = np.unique(cells)
        nearest = known[away[:, known].argmin(axis=1)]
        off[cells[None, :] != nearest[:, None]] = np.inf
        return {i: used[b]["block"] for i, b in zip(table.column("id").to_pylist(), off.argmin(axis=1))}

    @staticmethod
    def _may_admit(moved: DataFrame, meta: list[dict], pivots: np.ndarray) -> set[int]:
        """Blocks with a list that one of the changed items may enter."""
        table = moved.toArrow()
        used = [m for m in meta if m["block"] != NOWHERE and m["size"]]
        if not table.num_rows or not used:
            return set()
        low, high, least = (np.array([m[c] for m in used]) for c in ("low", "high", "least"))
        bounds = Bounds("cosine", pivots, np.array([m["cell"] for m in used]), low, high, np.array([m["size"] for m in used]))
        open_ = (bounds.of(_vectors(table), None) >= least - 1e-9).any(axis=0)
        return {m["block"] for m, o in zip(used, open_) if o}
