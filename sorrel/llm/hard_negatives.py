"""Hard-negative mining by Four-Russians scoring of whole-number vectors.

Components are whole numbers in two's complement. A candidate is held as *bit planes*: for each
bit and each group of eight dimensions one byte with that bit of the eight components. For each
group of eight dimensions of an anchor a table has the sums of all 256 subsets of its components,
so a plane of a candidate adds one table entry per group, and the planes are added up by shifts:
``score = -S[top]``, then ``score = 2 * score + S[plane]`` downwards. The scores are the full,
exact inner products; no pair is left out or estimated.

Candidates are dealt into shards of bounded size; a shard is packed once and the anchors stream
past it in Arrow batches. Two passes run over the shards. The first scores anchors against rows of
their own label and gives the positives. The second scores them against all other rows and keeps
the best negatives inside each positive's window. Of each shard only the few best rows per anchor,
or per anchor and positive, go on.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sorrel.llm.common import shuffle_partitions, stored

SCALE = 256
SHARD_ROWS, LEAST_SHARD = 65_536, 1_024
#: Anchors whose tables are held at a time, and candidates scored against them at a time.
ANCHORS, CHUNK = 64, 4_096
LONG = 2**63 - 1
PACKED = "vec_id long, label long, length int, planes int, bits binary"


def whole_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``(vec_id, label, v)`` with ``floor(scale * x)``; rows that take no part drop out."""
    plain = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.transform("embedding", lambda x: x.cast("double")).alias("x"),
    ).where("vec_id is not null and label is not null and x is not null")
    fine = F.forall("x", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return plain.where(fine & (F.size("x") > 0)).select("vec_id", "label", F.transform("x", lambda x: F.floor(x * scale)).alias("v"))


def bit_planes(values: np.ndarray) -> np.ndarray:
    """Bytes by row, plane (the sign first) and group of eight dimensions, of ``(rows, length)`` whole numbers."""
    least, most = int(values.min(initial=0)), int(values.max(initial=0))
    planes = max((-least - 1).bit_length() if least < 0 else 0, most.bit_length()) + 1
    length = values.shape[1]
    padded = np.zeros((len(values), -(-length // 8) * 8), np.int64)
    padded[:, :length] = values
    shifts = np.arange(planes - 1, -1, -1, dtype=np.int64)[None, :, None]
    return np.packbits((padded[:, None, :] >> shifts & 1).astype(np.uint8), axis=2, bitorder="little")


def from_planes(bits: np.ndarray, length: int) -> np.ndarray:
    """The whole numbers of ``bit_planes``."""
    flags = np.unpackbits(bits, axis=2, bitorder="little")[:, :, :length].astype(np.int64)
    out = -flags[:, 0]
    for plane in range(1, flags.shape[1]):
        out = 2 * out + flags[:, plane]
    return out


def subset_sums(anchors: np.ndarray, dtype: type) -> np.ndarray:
    """By group of eight dimensions, subset and anchor: the sum of the anchor's components in the subset."""
    groups = -(-anchors.shape[1] // 8)
    padded = np.zeros((len(anchors), groups * 8), dtype)
    padded[:, : anchors.shape[1]] = anchors
    sums = np.zeros((groups, 256, len(anchors)), dtype)
    for bit in range(8):
        # Subsets with this dimension as their largest are the smaller subsets and it.
        sums[:, 1 << bit : 2 << bit] = sums[:, : 1 << bit] + padded[:, bit::8].T[:, None, :]
    return sums


def scores(anchors: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Exact inner products by anchor and candidate; beyond a long they are kept at its ends."""
    planes = bits.shape[1]
    most = max((sum(abs(int(x)) for x in row) for row in anchors), default=0) << (planes - 1)
    dtype = np.int32 if most < 2**31 else np.int64 if most <= LONG else object
    sums = subset_sums(anchors, dtype)
    out = np.empty((len(anchors), len(bits)), np.int32 if dtype is np.int32 else np.int64)
    for start in range(0, len(bits), CHUNK):
        part = bits[start : start + CHUNK]
        total = None
        for plane in range(planes):
            found = sums[0].take(part[:, plane, 0], axis=0)
            for group in range(1, part.shape[2]):
                found += sums[group].take(part[:, plane, group], axis=0)
            if plane == 0:
                total = -found
            else:
                total *= 2
                total += found
        if dtype is object:
            total = np.clip(total, -LONG - 1, LONG).astype(np.int64)
        out[:, start : start + CHUNK] = total.T
    return out


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column("v")
        lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
        for length in np.unique(lengths):
            rows = np.flatnonzero(lengths == length)
            part = batch.take(pa.array(rows))
            bits = bit_planes(part.column("v").flatten().to_numpy(zero_copy_only=False).reshape(len(rows), int(length)))
            yield pa.RecordBatch.from_arrays([
                part.column("vec_id"), part.column("label"), pa.array(np.full(len(rows), length, np.int32)),
                pa.array(np.full(len(rows), bits.shape[1], np.int32)), pa.array([b.tobytes() for b in bits], pa.binary()),
            ], names=["vec_id", "label", "length", "planes", "bits"])


def _unpacked(rows: pa.Table) -> np.ndarray:
    """The bit planes of the rows, all with as many planes as the widest, by repeating their sign plane."""
    planes, groups = rows.column("planes").to_numpy(), -(-rows.column("length")[0].as_py() // 8)
    out = np.empty((len(planes), int(planes.max()), groups), np.uint8)
    packed = rows.column("bits").to_pylist()
    for p in np.unique(planes):
        at = np.flatnonzero(planes == p)
        part = np.frombuffer(b"".join(packed[i] for i in at), np.uint8).reshape(len(at), p, groups)
        out[at, out.shape[1] - p :] = part
        out[at, : out.shape[1] - p] = part[:, :1]
    return out


class Shard:
    """The candidates of one shard, by id."""

    def __init__(self, rows: pa.Table):
        self.ids, self.labels, self.bits = rows.column("vec_id").to_numpy(), rows.column("label").to_numpy(), _unpacked(rows)
        self.by_label = {x: np.flatnonzero(self.labels == x) for x in np.unique(self.labels).tolist()}


def _past_shards(work: Callable[[Shard, pa.Table, np.ndarray], Iterator[tuple]], schema: pa.Schema):
    """Rows sorted by shard, with the candidates of a shard before its anchors: ``work`` gets a few anchors at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, shard = None, [], None
        for batch in batches:
            marks = np.stack([batch.column(c).to_numpy() for c in ("shard", "length", "kind")])
            cuts = np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1
            for a, b in zip(np.r_[0, cuts], np.r_[cuts, batch.num_rows]):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                if (now := tuple(marks[:2, a].tolist())) != key:
                    key, held, shard = now, [], None
                if marks[2, a] == 0:
                    held.append(part)
                    continue
                if shard is None and held:
                    shard, held = Shard(pa.Table.from_batches(held)), []
                if shard is None:
                    continue
                for start in range(0, part.num_rows, ANCHORS):
                    few = pa.Table.from_batches([part.slice(start, ANCHORS)])
                    found = list(work(shard, few, from_planes(_unpacked(few), key[1])))
                    if found:
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in map(np.concatenate, zip(*found))], schema=schema)

    return run


def _best_of_own_label(k: int):
    def work(shard: Shard, few: pa.Table, anchors: np.ndarray) -> Iterator[tuple]:
        own, labels = few.column("vec_id").to_numpy(), few.column("label").to_numpy()
        for label in np.unique(labels).tolist():
            at, mine = shard.by_label.get(label), np.flatnonzero(labels == label)
            if at is None:
                continue
            found = scores(anchors[mine], shard.bits[at])
            for i, row in zip(mine, found):
                if len(row) > k + 1:
                    near = np.flatnonzero(row >= np.partition(row, -k - 1)[-k - 1])
                    near = near[np.argsort(-row[near].astype(np.int64), kind="stable")]
                else:
                    near = np.argsort(-row.astype(np.int64), kind="stable")
                # More rows than one may bear the anchor's id, and many may share the k-th score.
                near = near[shard.ids[at[near]] != own[i]][:k]
                if len(near) < k < len(row):
                    near = np.argsort(-row.astype(np.int64), kind="stable")
                    near = near[shard.ids[at[near]] != own[i]][:k]
                if len(near):
                    yield np.full(len(near), own[i]), shard.ids[at[near]], row[near].astype(np.int64)

    return work


def _best_in_windows(k: int):
    def work(shard: Shard, few: pa.Table, anchors: np.ndarray) -> Iterator[tuple]:
        own, labels = few.column("vec_id").to_numpy(), few.column("label").to_numpy()
        for i, (row, windows) in enumerate(zip(scores(anchors, shard.bits), few.column("windows").to_pylist())):
            low, high = min(w["low"] for w in windows), max(w["high"] for w in windows)
            near = np.flatnonzero((row >= low) & (row <= high) & (shard.labels != labels[i]) & (shard.ids != own[i]))
            if not len(near):
                continue
            # Best first; equal scores stay in the order of ids.
            near = near[np.argsort(-row[near].astype(np.int64), kind="stable")]
            down = -row[near].astype(np.int64)
            for w in windows:
                start, stop = np.searchsorted(down, -w["high"], "left"), np.searchsorted(down, -w["low"], "right")
                best = near[start : min(stop, start + k)]
                if len(best):
                    yield np.full(len(best), own[i]), np.full(len(best), w["nth"]), shard.ids[best], row[best].astype(np.int64)

    return work


def _streamed(candidates: DataFrame, anchors: DataFrame, shards: int) -> DataFrame:
    """Every shard of candidates, sorted by id and followed by all anchors of their length."""
    copies = anchors.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).withColumn("kind", F.lit(1))
    rows = candidates.withColumn("kind", F.lit(0)).unionByName(copies, allowMissingColumns=True)
    dealt = rows.repartition(min(shards, shuffle_partitions(candidates.sparkSession)), "shard")
    return dealt.sortWithinPartitions("shard", "length", "kind", F.when(F.col("kind") == 1, F.col("label")), "vec_id")


def _ranked(found: DataFrame, by: list[str], k: int, name: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id")
    return found.withColumn(name, F.row_number().over(order)).where(F.col(name) <= k)


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
    scale: int = SCALE, shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``vectors`` has ``vec_id, embedding, label``, and ``is_anchor`` is a condition on ``vec_id``. An
    anchor's positives are the best other rows of its label; the negatives of a positive are the best
    rows of other labels with ``low * positive_score <= 100 * negative_score <= high * positive_score``.
    Equal scores go to the smaller id.

    Rows without an id, a label or a whole finite vector take no part; only vectors of equal length
    meet. An anchor whose id is repeated is taken once, as the smallest of its rows by label and
    vector; rows that bear the anchor's id are never its positives or negatives. Another repeated row
    counts as often as it occurs. Scores beyond a long are kept at its ends. Further columns do not
    matter, and empty tables give an empty result.
    """
    packed = stored(whole_vectors(vectors, scale).mapInArrow(_pack, PACKED))
    total = packed.count()
    shards = max(1, -(-total // shard_rows), min(shuffle_partitions(packed.sparkSession), -(-total // LEAST_SHARD)))
    # Rows are dealt by their place in the stored table, so that a repeated id spreads as well.
    spread = F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(shards)).cast("int")
    candidates = packed.withColumn("shard", spread)
    once = packed.where(is_anchor).groupBy("vec_id").agg(F.min(F.struct("label", "length", "planes", "bits")).alias("row"))
    anchors = stored(once.select("vec_id", "row.*"))

    found_schema = pa.schema([("anchor_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
    own = _streamed(candidates, anchors, shards).mapInArrow(
        _past_shards(_best_of_own_label(positives), found_schema), "anchor_id long, vec_id long, score long"
    )
    chosen = stored(_ranked(own, ["anchor_id"], positives, "nth"))

    # 100 * score within low and high per cent of the positive's, as bounds of the score itself; decimals do not overflow.
    wide = F.col("score").cast("decimal(20,0)")
    window = F.struct(
        F.col("nth").cast("long").alias("nth"), F.ceil(wide * low / 100).cast("long").alias("low"),
        F.floor(wide * high / 100).cast("long").alias("high"),
    )
    asked = chosen.groupBy("anchor_id").agg(F.collect_list(window).alias("windows"))
    waiting = anchors.join(asked, F.col("vec_id") == F.col("anchor_id")).drop("anchor_id")
    found_schema = pa.schema([("anchor_id", pa.int64()), ("nth", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
    other = _streamed(candidates, waiting, shards).mapInArrow(
        _past_shards(_best_in_windows(negatives), found_schema), "anchor_id long, nth long, vec_id long, score long"
    )
    best = _ranked(other, ["anchor_id", "nth"], negatives, "rank")
    pairs = chosen.select("anchor_id", F.col("nth").cast("long").alias("nth"), F.col("vec_id").alias("positive_id"),
                          F.col("score").alias("positive_score"))
    return best.join(pairs, ["anchor_id", "nth"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )
