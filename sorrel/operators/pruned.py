"""Exact nearest items without all pairs: blocks of neighbours, bounds and running k-th scores.

Items are put in *cells* and each cell is cut, by distance from the cell's pivot, into *blocks* of
bounded size. All members of a block lie between its least and its greatest distance (an annulus), so
the triangle inequality bounds what a block can hold for a given vector:

* cosine and Pearson work on unit vectors, where ``cos = 1 - d * d / 2``; euclidean works on ``d`` itself.
  The pivots are sampled items and a cell has the items closest to its pivot;
* inside groups (clusters) the pivot is the group's mean, and only blocks of the own group count;
* for inner products there is one cell around the origin, so that blocks are ordered by norm and
  ``|q| * greatest norm`` is the bound of Cauchy and Schwarz.

The answer comes in waves. A vector first meets its own block, or the one with the best bound, then the
best two blocks left, then four, then all others. Before each wave, blocks whose bound is below the
vector's k-th score so far are struck off. The items are stored once, by block; in a wave they are joined
by the vectors that ask for the block, which stream past it, a block that many ask for being held by
several tasks. Vectors are shuffled once per block asked for, not once per block there is.

Where bounds strike off too little, as among vectors without any clusters, the block join of ``topk`` gives
the same rows for less, and is taken instead.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sorrel.operators import topk
from sorrel.operators.ranking import rank_within
from sorrel.operators.topk import LOWER_IS_BETTER, SLICE_SCORES, _best, _prepared, _Scorer, _trim, _vectors, keep_best
from sorrel.session import materialise, shuffle_partitions

METRICS = ("cosine", "pearson", "euclidean", "dot")
BLOCK_ROWS = 4_096
PIVOTS = 1_024
#: Vectors that ask for one block and meet it in one task, and vectors compared at a time.
REQUESTS, AT_ONCE = 1 << 16, 1_024
#: What of an index may go to every task.
INDEX_BYTES = 64 << 20
#: Share of all pairs above which pruning is given up, and the waves after which that is judged.
WORTH, SETTLED = 0.5, 2
WAVES = (1, 2, 4, None)
ITEM, MASK, REQUEST = 0, 1, 2


@dataclass
class Bounds:
    """What is known of the blocks: cell, least and greatest distance from its pivot, and size."""

    metric: str
    pivots: np.ndarray
    cells: np.ndarray
    low: np.ndarray
    high: np.ndarray
    sizes: np.ndarray

    def of(self, vectors: np.ndarray, own: np.ndarray | None) -> np.ndarray:
        """Upper bound on the score that each vector can have with any member of each block.

        ``own`` has the only cell that counts for each vector. Bounds are rounded up by more than the
        distances may be off.
        """
        norms = np.sqrt((vectors * vectors).sum(axis=1))[:, None]
        if self.metric == "dot":
            return norms * self.high * (1 + 1e-12) + 1e-9
        if own is None:
            away = distances(vectors, self.pivots)[:, self.cells]
        else:
            away = distances_one(vectors, self.pivots[np.maximum(own, 0)])[:, None]
        slack = 1e-6 * (norms + self.high + 1e-9)
        least = np.maximum(np.maximum(away - self.high, self.low - away) - slack, 0)
        out = -least if self.metric == "euclidean" else 1 - least * least / 2
        if own is not None:
            out[self.cells[None, :] != own[:, None]] = -np.inf
        return out + 1e-9


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squares = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * (a @ b.T)
    return np.sqrt(np.maximum(squares, 0))


def distances_one(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of each row from the row beside it."""
    return np.sqrt(((a - b) ** 2).sum(axis=1))


def _ready(df: DataFrame, metric: str, id_col: str, vec_col: str, group_col: str | None) -> DataFrame:
    """``(id, cell, vec)`` with the vectors in the form whose product or distance is the metric."""
    schema = pa.schema([("id", pa.int64()), ("cell", pa.int64()), ("vec", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            made = _prepared(metric, _vectors(pa.Table.from_batches([batch])))
            fine = np.flatnonzero(np.isfinite(made).all(axis=1))
            kept = batch.take(pa.array(fine))
            yield pa.RecordBatch.from_arrays([kept.column("id"), kept.column("cell"), _lists(made[fine])], schema=schema)

    cell = F.col(group_col).cast("bigint") if group_col else F.lit(0).cast("bigint")
    known = df.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & cell.isNotNull())
    shaped = known.select(F.col(id_col).cast("bigint").alias("id"), cell.alias("cell"), F.col(vec_col).cast("array<double>").alias("vec"))
    return shaped.mapInArrow(run, "id bigint, cell bigint, vec array<double>")


def _lists(rows: np.ndarray) -> pa.Array:
    """A list per row of a matrix."""
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(rows).ravel()))


def _pivots(rows: DataFrame, metric: str, grouped: bool, total: int, block_rows: int) -> tuple[np.ndarray, np.ndarray | None] | None:
    """Pivots, with the cell that each belongs to where cells are given; None if they are too many for every task."""
    first = rows.select("vec").head()
    if first is None:
        return None
    width = len(first[0])
    if metric == "dot":
        return np.zeros((1, width)), None
    if not grouped:
        wanted = max(1, min(PIVOTS, INDEX_BYTES // 2 // (8 * width), -(-total // block_rows)))
        chosen = rows.select("vec", F.xxhash64("id", F.lit("pivot")).alias("h")).orderBy("h").limit(wanted).toArrow()
        return _vectors(chosen.select(["vec"])), None
    means = rows.groupBy("cell").agg(Summarizer.mean(array_to_vector("vec")).alias("m"))
    means = materialise(means.select("cell", vector_to_array("m").alias("vec")))
    if means.count() * (8 * width + 8) > INDEX_BYTES // 2:
        return None
    found = means.orderBy("cell").toArrow()
    return _vectors(found), found.column("cell").to_numpy()


def _with_cells(pivots: Broadcast, names: np.ndarray | None):
    schema = pa.schema([("id", pa.int64()), ("vec", pa.list_(pa.float64())), ("cell", pa.int64()), ("away", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows, places = _vectors(pa.Table.from_batches([batch])), pivots.value
            if names is None:
                cell = distances(rows, places).argmin(axis=1)
            else:
                cell = np.searchsorted(names, batch.column("cell").to_numpy())
            away = distances_one(rows, places[cell])
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("vec"), pa.array(cell), pa.array(away)], schema=schema)

    return run


def build_index(ready: DataFrame, metric: str, grouped: bool, block_rows: int) -> tuple[DataFrame, Bounds, np.ndarray | None] | None:
    """Items with their ``cell`` and ``block``, the bounds of all blocks, and the names of given cells."""
    spark = ready.sparkSession
    total = ready.count()
    chosen = _pivots(ready, metric, grouped, total, block_rows)
    if chosen is None:
        return None
    pivots, names = chosen
    placed = ready.mapInArrow(_with_cells(spark.sparkContext.broadcast(pivots), names), "id bigint, vec array<double>, cell bigint, away double")
    # Cut by distance however large one cell is; blocks of a cell are as even as they come.
    ranked = rank_within(placed, "cell", [F.col("away"), F.col("id")], "nth")
    ranked = ranked.withColumn("nth", F.floor((F.col("nth") - 1) / block_rows).cast("bigint"))
    stats = materialise(ranked.groupBy("cell", "nth").agg(
        F.min("away").alias("low"), F.max("away").alias("high"), F.count(F.lit(1)).alias("size")
    ))
    if stats.count() * 48 > INDEX_BYTES // 2:
        return None
    found = stats.orderBy("cell", "nth").toArrow()
    cells = found.column("cell").to_numpy()
    low, high, sizes = (found.column(c).to_numpy() for c in ("low", "high", "size"))
    starts, first = np.unique(cells, return_index=True)
    numbers = spark.createDataFrame(list(zip(starts.tolist(), first.tolist())), "cell bigint, _first bigint")
    rows = ranked.join(F.broadcast(numbers), "cell").select(
        "id", "vec", "cell", (F.col("_first") + F.col("nth")).cast("int").alias("block")
    )
    return rows, Bounds(metric, pivots, cells, low, high, sizes), names


def _plan(bounds: Broadcast, k: int, most: int | None, grouped: bool):
    """Adds the blocks each vector asks for in this wave, ``to``, and how many items the open blocks hold, ``rest``."""
    schema = pa.schema([
        ("id", pa.int64()), ("vec", pa.list_(pa.float64())), ("cell", pa.int64()), ("seen", pa.list_(pa.int32())),
        ("to", pa.list_(pa.int32())), ("rest", pa.int64()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = bounds.value
        step = max(1, SLICE_SCORES // max(1, len(known.sizes)))
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                vectors = _vectors(pa.Table.from_batches([part]))
                bound = known.of(vectors, part.column("cell").to_numpy() if grouped else None)
                floors = pc.fill_null(part.column("floor"), -np.inf).to_numpy(zero_copy_only=False)
                seen = part.column("seen")
                bound[np.repeat(np.arange(len(bound)), pc.list_value_length(seen)), seen.flatten()] = -np.inf
                # The margin of rounded scores is in the bounds; a bound as low as the floor may still hold a lower id.
                open_ = (bound >= floors[:, None] - 1e-9) & (bound > -np.inf)
                rest = open_ @ known.sizes
                if most is not None and most < bound.shape[1]:
                    kth = np.partition(np.where(open_, bound, -np.inf), -most, axis=1)[:, -most, None]
                    open_ &= bound >= kth
                    # Equal bounds may be many: the first ones go now, the others later.
                    open_ &= np.cumsum(open_, axis=1) <= most
                at, block = np.nonzero(open_)
                offsets = np.searchsorted(at, np.arange(len(bound) + 1)).astype(np.int32)
                to = pa.ListArray.from_arrays(pa.array(offsets), pa.array(block.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("vec"), part.column("cell"), seen, to, pa.array(rest.astype(np.int64))], schema=schema
                )

    return run


def _meet(metric: str, k: int, exclude_self: bool):
    """Vectors past the blocks they ask for; rows sorted by block, items first, then by id with masks before requests."""

    def compare(rid, b, held: list[tuple], masks: dict[int, np.ndarray]) -> pa.RecordBatch:
        lid, a = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
        scorer, out = _Scorer(metric, a, b), []
        step = max(1, SLICE_SCORES // len(rid))
        for at in range(0, len(lid), step):
            ids = lid[at : at + step]
            scores = scorer.rough(at, at + step)
            for i, x in enumerate(ids.tolist()):
                if (gone := masks.get(x)) is not None:
                    scores[i, np.searchsorted(rid, gone)] = -np.inf
            if exclude_self:
                place = np.minimum(np.searchsorted(rid, ids), len(rid) - 1)
                same = np.flatnonzero(rid[place] == ids)
                scores[same, place[same]] = -np.inf
            rows, cols, values = _best(scores, k, scorer, lambda s, r, c: scorer.exact(s, r + at, c))
            out.append((ids[rows], rid[cols], values))
        best = _trim(*(np.concatenate(parts) for parts in zip(*out)), k)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in best], names=["base", "item", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, items, block, masks = None, [], None, {}
        for batch in batches:
            marks = np.stack([batch.column(c).to_numpy() for c in ("block", "slot")])
            kinds = batch.column("kind").to_numpy()
            cuts = np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1
            for a, b in zip(np.r_[0, cuts], np.r_[cuts, batch.num_rows]):
                if a == b:
                    continue
                if (now := tuple(marks[:, a].tolist())) != key:
                    key, items, block, masks = now, [], None, {}
                part, kind = pa.Table.from_batches([batch.slice(a, b - a)]), kinds[a:b]
                if (kind == ITEM).any():
                    rows = part.filter(pa.array(kind == ITEM))
                    items.append((rows.column("id").to_numpy(), _vectors(rows)))
                if (kind == MASK).any():
                    rows = part.filter(pa.array(kind == MASK))
                    masks |= {i: np.sort(np.array(m)) for i, m in zip(rows.column("id").to_pylist(), rows.column("mask").to_pylist())}
                asking = part.filter(pa.array(kind == REQUEST))
                if not asking.num_rows:
                    continue
                if block is None:
                    block = np.concatenate([x[0] for x in items]), np.concatenate([x[1] for x in items])
                for start in range(0, asking.num_rows, AT_ONCE):
                    few = asking.slice(start, AT_ONCE)
                    yield compare(*block, [(few.column("id").to_numpy(), _vectors(few))], masks)
                # A mask stands right before its request; only the last one may wait for the next batch.
                last = asking.column("id")[-1].as_py()
                masks = {i: m for i, m in masks.items() if i > last}

    return run


def _wave(planned: DataFrame, rows: DataFrame, counts: dict[int, int], masks: DataFrame | None, metric: str, k: int, exclude_self: bool) -> DataFrame:
    """Best ``k`` per vector and block asked for."""
    spark = planned.sparkSession
    spread = [(b, -(-n // REQUESTS)) for b, n in counts.items()]
    # One short row per block; the index was checked to be small.
    slots = F.broadcast(spark.createDataFrame(spread, "block int, _slots int"))
    slot = lambda column: F.pmod(F.xxhash64(column), F.col("_slots")).cast("int").alias("slot")
    held = rows.join(slots, "block").select(
        "block", F.explode(F.sequence(F.lit(0), F.col("_slots") - 1)).alias("slot"), F.lit(ITEM).alias("kind"), "id", "vec"
    )
    asked = planned.select("id", "vec", F.explode("to").alias("block")).join(slots, "block").select(
        "block", slot("id"), F.lit(REQUEST).alias("kind"), "id", "vec"
    )
    stream = held.unionByName(asked).withColumn("mask", F.lit(None).cast("array<bigint>"))
    if masks is not None:
        stream = stream.unionByName(masks.join(slots, "block").select(
            "block", slot("base"), F.lit(MASK).alias("kind"), F.col("base").alias("id"),
            F.lit(None).cast("array<double>").alias("vec"), "mask",
        ))
    n = max(shuffle_partitions(spark), len(spread) // 16)
    dealt = stream.repartition(n, "block", "slot").sortWithinPartitions("block", "slot", F.col("kind") != ITEM, "id", "kind")
    return dealt.mapInArrow(_meet(metric, k, exclude_self), "base bigint, item bigint, score double")


def top_matches_pruned(
    base: DataFrame, items: DataFrame | None, k: int, metric: str, id_col: str, vec_col: str, group_col: str | None = None,
    exclude_self: bool = True, exclude: DataFrame | None = None, block_rows: int | None = None, worth: float = WORTH,
    report: list | None = None,
) -> DataFrame:
    """The rows of ``topk.top_matches``, by bounds.

    ``report`` gets a row per wave: blocks asked for, pairs of vectors compared, and the share of all pairs that the
    open blocks hold before it. The last row says whether the block join took over, as it does when the open blocks
    hold more than the share ``worth`` of all pairs.
    """
    block_rows = block_rows or BLOCK_ROWS
    report = [] if report is None else report

    def by_blocks() -> DataFrame:
        report.append({"wave": "block join"})
        return topk.top_matches(base, items, k, metric, id_col, vec_col, group_col, exclude_self, exclude, prune=False)

    if metric not in METRICS or (group_col and items is not None) or (group_col and metric == "dot"):
        raise ValueError("bounds are for cosine, pearson, euclidean and dot, and groups for one set of items")
    spark = base.sparkSession
    ready = materialise(_ready(base if items is None else items, metric, id_col, vec_col, group_col))
    index = build_index(ready, metric, bool(group_col), block_rows)
    if index is None:
        return by_blocks()
    rows, bounds, _ = index
    rows = materialise(rows)
    nothing = F.array().cast("array<int>")
    if items is None:
        requests = rows.select("id", "vec", "cell", nothing.alias("seen"), F.array("block").alias("to"))
    else:
        asking = _ready(base, metric, id_col, vec_col, None)
        requests = asking.select("id", "vec", "cell", nothing.alias("seen"), F.lit(None).cast("array<int>").alias("to"))
    masks = None
    if exclude is not None:
        gone = exclude.select(F.col("base").cast("bigint").alias("base"), F.col("item").cast("bigint").alias("item")).distinct()
        met = gone.join(rows.select(F.col("id").alias("item"), "block"), "item")
        # No longer than a block has items.
        masks = materialise(met.groupBy("base", "block").agg(F.collect_list("item").alias("mask")))

    shared = spark.sparkContext.broadcast(bounds)
    n_requests = None
    columns = "id bigint, vec array<double>, cell bigint, seen array<int>, to array<int>, rest bigint"
    best, floors = None, None
    for wave, most in enumerate(WAVES):
        if wave == 0 and items is None:
            planned = requests.withColumn("rest", F.lit(0).cast("bigint"))
        else:
            waiting = requests.drop("to")
            waiting = waiting.withColumn("floor", F.lit(None).cast("double")) if floors is None else waiting.join(floors, "id", "left")
            planned = waiting.select("id", "vec", "cell", "seen", "floor").mapInArrow(_plan(shared, k, most, bool(group_col)), columns)
            # A vector without open blocks is done.
            planned = planned.where(F.size("to") > 0)
        planned = materialise(planned)
        if n_requests is None:
            n_requests = planned.count()
            every = n_requests * int(bounds.sizes.sum())
        counts = {r["block"]: r["count"] for r in planned.select(F.explode("to").alias("block")).groupBy("block").count().collect()}
        if not counts:
            break
        rest = planned.agg(F.sum("rest")).head()[0] or 0
        if wave >= SETTLED and not group_col and rest > worth * every:
            return by_blocks()
        pairs = sum(n * int(bounds.sizes[b]) for b, n in counts.items())
        report.append({"wave": wave + 1, "asked": sum(counts.values()), "pairs": pairs, "open": rest / max(1, every)})
        found = _wave(planned, rows, counts, masks, metric, k, exclude_self)
        best = materialise(keep_best(found if best is None else found.unionByName(best.drop("rank")), k))
        floors = best.where(F.col("rank") == k).select(F.col("base").alias("id"), F.col("score").alias("floor"))
        requests = planned.select("id", "vec", "cell", F.concat("seen", "to").alias("seen"), "to")
    if best is None:
        return by_blocks()
    if group_col:
        named = (base if items is None else items).select(F.col(id_col).cast("bigint").alias("base"), group_col)
        best = best.join(named, "base").select(group_col, "base", "item", "score", "rank")
    return best.withColumn("score", -F.col("score")) if metric in LOWER_IS_BETTER else best
