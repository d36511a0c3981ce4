"""Matrix factorisation by alternating least squares over blocks of normal equations.

Ratings lie in a grid of user buckets by item buckets, packed into arrays once. In a half step the factors
of one side go to the cells of their bucket; a cell adds up, for each of its users (or items), the outer
products ``v v'`` and the sums ``r v``, and these partial sums of a bucket meet for the solution of
``(sum v v' + reg * n * I) x = sum r v``. A user with a third of all ratings is so spread over the item buckets,
and an item over the user buckets. Factors start from a hash of the id, and partial sums are added in the
order of their cells, so that the partitioning of the ratings does not matter: the result is that of a plain
sequential program but for the rounding of sums.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sorrel.session import materialise, shuffle_partitions

#: Ratings of a cell, and bytes of factors or of partial sums that meet in one task, aimed at.
CELL, MEET_BYTES = 1 << 20, 64 << 20
#: Ratings whose outer products are held at a time.
AT_ONCE = 1 << 14


@dataclass
class Factors:
    """Factors ``(id, features)`` by the caller's own 64-bit ids."""

    users: DataFrame
    items: DataFrame
    rank: int


def hashed_start(ids: Column, rank: int, seed: int = 42) -> Column:
    """Positive numbers below ``1 / sqrt(rank)``, from a hash of seed, place and id."""

    def unit(place: Column) -> Column:
        name = F.concat_ws("-", F.lit(f"als-{seed}"), place.cast("string"), ids.cast("string"))
        return F.conv(F.substring(F.md5(name), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52)) / math.sqrt(rank)

    return F.transform(F.sequence(F.lit(0), F.lit(rank - 1)), unit)


def _grid(ratings: int, users: int, items: int, rank: int, cores: int) -> tuple[int, int]:
    """User and item buckets for cells, factors and partial sums of bounded size."""
    side = max(1, math.ceil(math.sqrt(max(cores, ratings / CELL))))
    q = max(side, math.ceil(items * rank * 8 / MEET_BYTES))
    p = max(side, math.ceil(users * rank * 8 / MEET_BYTES))
    sums = (rank + 1) * (rank + 2) * 4
    return max(p, math.ceil(users * q * sums / MEET_BYTES)), max(q, math.ceil(items * p * sums / MEET_BYTES))


def _packed_cells(known: DataFrame, p: int, q: int) -> DataFrame:
    """``(p, q, users, items, scores)`` with the ratings of a cell as arrays, sorted by user and item."""

    def pack(key, table):
        table = table.sort_by([("user_id", "ascending"), ("item_id", "ascending"), ("score", "ascending")])
        arrays = [table.column(c).to_numpy().tobytes() for c in ("user_id", "item_id", "score")]
        return pa.table({"p": [key[0].as_py()], "q": [key[1].as_py()], **{n: [a] for n, a in zip(("users", "items", "scores"), arrays)}}, schema=schema)

    schema = pa.schema([("p", pa.int32()), ("q", pa.int32()), *[(n, pa.binary()) for n in ("users", "items", "scores")]])
    bucket = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    dealt = known.withColumns({"p": bucket("user_id", p), "q": bucket("item_id", q)})
    dealt = dealt.repartition(shuffle_partitions(known.sparkSession), "p", "q")
    return materialise(dealt.groupBy("p", "q").applyInArrow(pack, "p int, q int, users binary, items binary, scores binary"))


def _packed_factors(factors: DataFrame, buckets: int, side: str) -> DataFrame:
    """One row per bucket: ids in order, and their factors."""

    def pack(key, table):
        table = table.sort_by("id")
        vectors = table.column("features").combine_chunks()
        flat = (vectors.chunk(0) if isinstance(vectors, pa.ChunkedArray) else vectors).flatten().to_numpy()
        return pa.table({side: [key[0].as_py()], "ids": [table.column("id").to_numpy().tobytes()], "vecs": [flat.tobytes()]}, schema=schema)

    schema = pa.schema([(side, pa.int32()), ("ids", pa.binary()), ("vecs", pa.binary())])
    dealt = factors.withColumn(side, F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int"))
    return dealt.groupBy(side).applyInArrow(pack, f"{side} int, ids binary, vecs binary")


def partial_sums(base: np.ndarray, other: np.ndarray, scores: np.ndarray, ids: np.ndarray, vecs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By id of ``base``, in order: the sums of ``v v'``, ``r v`` and 1 over its ratings of ``other``."""
    order = np.argsort(base, kind="stable")
    base, other, scores = base[order], other[order], scores[order]
    names, starts = np.unique(base, return_index=True)
    rank = vecs.shape[1]
    out = np.zeros((len(names), rank * rank + rank + 1))
    for at in range(0, len(base), AT_ONCE):
        rows = vecs[np.searchsorted(ids, other[at : at + AT_ONCE])]
        terms = np.concatenate([
            (rows[:, :, None] * rows[:, None, :]).reshape(len(rows), -1), rows * scores[at : at + AT_ONCE, None], np.ones((len(rows), 1)),
        ], axis=1)
        first, last = np.searchsorted(starts, [at, at + len(rows) - 1], side="right") - 1
        cuts = np.maximum(starts[first : last + 1] - at, 0)
        out[first : last + 1] += np.add.reduceat(terms, cuts, axis=0)
    return names, out


def solve(sums: np.ndarray, rank: int, reg: float) -> np.ndarray:
    """Factors from whole sums; without regularisation the least of equally good ones."""
    left = sums[:, : rank * rank].reshape(-1, rank, rank) + (reg * sums[:, -1])[:, None, None] * np.eye(rank)
    right = sums[:, rank * rank : -1, None]
    if reg > 0:
        return np.linalg.solve(left, right)[:, :, 0]
    return (np.linalg.pinv(left, hermitian=True) @ right)[:, :, 0]


def _half_step(cells: DataFrame, factors: DataFrame, buckets: int, side: str, rank: int, reg: float) -> DataFrame:
    """New factors of the other side from those of ``side`` (``q`` holds items, ``p`` users)."""
    base, other, group = ("users", "items", "p") if side == "q" else ("items", "users", "q")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                array = lambda name, kind: np.frombuffer(r[name], kind)  # noqa: B023, E731
                names, sums = partial_sums(
                    array(base, np.int64), array(other, np.int64), array("scores", np.float64), array("ids", np.int64),
                    array("vecs", np.float64).reshape(-1, rank),
                )
                yield pa.RecordBatch.from_pydict({group: [r[group]], "cell": [r[side]], "names": [names.tobytes()], "sums": [sums.tobytes()]}, schema=added)

    added = pa.schema([(group, pa.int32()), ("cell", pa.int32()), ("names", pa.binary()), ("sums", pa.binary())])

    def meet(key, table):
        parts = sorted(table.to_pylist(), key=lambda r: r["cell"])
        names = np.concatenate([np.frombuffer(r["names"], np.int64) for r in parts])
        sums = np.concatenate([np.frombuffer(r["sums"], np.float64).reshape(-1, rank * rank + rank + 1) for r in parts])
        order = np.argsort(names, kind="stable")
        ids, starts = np.unique(names[order], return_index=True)
        found = solve(np.add.reduceat(sums[order], starts, axis=0), rank, reg)
        offsets = pa.array(np.arange(len(ids) + 1, dtype=np.int32) * rank)
        return pa.table({"id": ids, "features": pa.ListArray.from_arrays(offsets, pa.array(found.ravel()))})

    met = cells.join(_packed_factors(factors, buckets, side), side)
    sums = met.mapInArrow(add, f"{group} int, cell int, names binary, sums binary")
    return materialise(sums.groupBy(group).applyInArrow(meet, "id bigint, features array<double>"))


def factorise(ratings: DataFrame, rank: int = 10, iterations: int = 10, reg: float = 0.6, seed: int = 42) -> Factors:
    """Explicit-feedback factors of ``(user_id, item_id, score)``; rows with a null take no part.

    Several ratings of one pair all count. Items start from hashes; each iteration solves users, then items.
    """
    spark = ratings.sparkSession
    known = ratings.select(
        F.col("user_id").cast("bigint").alias("user_id"), F.col("item_id").cast("bigint").alias("item_id"),
        F.col("score").cast("double").alias("score"),
    ).where("user_id is not null and item_id is not null and score is not null and not isnan(score)")
    known = materialise(known)
    items = materialise(known.select(F.col("item_id").alias("id")).distinct())
    n_users, n_items = known.select("user_id").distinct().count(), items.count()
    p, q = _grid(known.count(), n_users, n_items, rank, spark.sparkContext.defaultParallelism)
    cells = _packed_cells(known, p, q)
    items = materialise(items.withColumn("features", hashed_start(F.col("id"), rank, seed)))
    users = None
    for _ in range(iterations):
        users = _half_step(cells, items, q, "q", rank, reg)
        items = _half_step(cells, users, p, "p", rank, reg)
    if users is None:
        raise ValueError("one iteration at least")
    return Factors(users, items, rank)
