"""Nearest items where one side is small: it goes to the tasks, and the large side is not shuffled.

The small side counts as such by its measured bytes; beyond ``FEW_BYTES`` both forms fall
back on the block join, which gives the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sorrel.operators.topk import (
    LOWER_IS_BETTER, SLICE_SCORES, _best, _prepared, _Scorer, _trim, _vectors, keep_best, top_matches,
)

FEW_BYTES = 32 << 20
FOUND = pa.schema([("base", pa.int64()), ("item", pa.int64()), ("score", pa.float64())])


def _shaped(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    known = df.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull())
    return known.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))


def _shared(few: DataFrame) -> Broadcast | None:
    """Ids and vectors of the small side for the tasks, or None if it is not small."""
    size = few.agg(F.sum(F.size("vec") * 8 + 16)).head()[0] or 0
    if size > FEW_BYTES:
        return None
    rows = few.toArrow().sort_by("id")
    return few.sparkSession.sparkContext.broadcast((rows.column("id").to_numpy(), _vectors(rows) if rows.num_rows else None))


def _compare(metric: str, lid: np.ndarray, a: np.ndarray, rid: np.ndarray, b: np.ndarray, k: int, exclude_self: bool):
    """Best ``k`` of the right side for every row of the left side; ``rid`` is sorted."""
    if a.shape[1] != b.shape[1]:
        raise ValueError(f"vectors differ in length: {a.shape[1]} and {b.shape[1]}")
    a, b = _prepared(metric, a), _prepared(metric, b)
    bad_row, bad_col = ~np.isfinite(a).all(axis=1), ~np.isfinite(b).all(axis=1)
    scorer, out = _Scorer(metric, a, b), []
    step = max(1, SLICE_SCORES // len(rid))
    for at in range(0, len(lid), step):
        ids = lid[at : at + step]
        scores = scorer.rough(at, at + step)
        scores[bad_row[at : at + step]] = -np.inf
        scores[:, bad_col] = -np.inf
        scores[np.isnan(scores)] = -np.inf
        if exclude_self:
            place = np.minimum(np.searchsorted(rid, ids), len(rid) - 1)
            same = np.flatnonzero(rid[place] == ids)
            scores[same, place[same]] = -np.inf
        rows, cols, values = _best(scores, k, scorer, lambda s, r, c: scorer.exact(s, r + at, c))
        out.append((ids[rows], rid[cols], values))
    return _trim(*(np.concatenate(parts) for parts in zip(*out)), k)


def best_of_few(
    base: DataFrame, few: DataFrame, k: int, metric: str, id_col: str, vec_col: str, exclude_self: bool = True
) -> DataFrame:
    """As ``top_matches(base, few, ...)``: every base is compared with the few where it lies."""
    right = _shaped(few, id_col, vec_col)
    shared = _shared(right)
    if shared is None:
        return top_matches(base, few, k, metric, id_col, vec_col, exclude_self=exclude_self)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rid, b = shared.value
        for batch in batches:
            if not batch.num_rows or not len(rid):
                continue
            table = pa.Table.from_batches([batch])
            one, other, value = _compare(metric, table.column("id").to_numpy(), _vectors(table), rid, b, k, exclude_self)
            starts = np.flatnonzero(np.r_[True, one[1:] != one[:-1]]) if len(one) else np.empty(0, int)
            rank = np.arange(len(one)) - np.repeat(starts, np.diff(np.r_[starts, len(one)])) + 1
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (one, other, value, rank)], schema=ranked)

    ranked = pa.schema([*FOUND, ("rank", pa.int64())])
    found = _shaped(base, id_col, vec_col).mapInArrow(run, "base bigint, item bigint, score double, rank bigint")
    found = found.withColumn("rank", F.col("rank").cast("int"))
    return found.withColumn("score", -F.col("score")) if metric in LOWER_IS_BETTER else found


def best_for_few(
    few: DataFrame, items: DataFrame, k: int, metric: str, id_col: str, vec_col: str, exclude_self: bool = True
) -> DataFrame:
    """As ``top_matches(few, items, ...)``: every task keeps the best ``k`` of its items for each of the few."""
    left = _shaped(few, id_col, vec_col)
    shared = _shared(left)
    if shared is None:
        return top_matches(few, items, k, metric, id_col, vec_col, exclude_self=exclude_self)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lid, a = shared.value
        best = tuple(np.empty(0, t) for t in (np.int64, np.int64, np.float64))
        for batch in batches:
            if not batch.num_rows or not len(lid):
                continue
            table = pa.Table.from_batches([batch]).sort_by("id")
            found = _compare(metric, lid, a, table.column("id").to_numpy(), _vectors(table), k, exclude_self)
            best = _trim(*(np.concatenate(parts) for parts in zip(best, found)), k)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in best], schema=FOUND)

    found = keep_best(_shaped(items, id_col, vec_col).mapInArrow(run, "base bigint, item bigint, score double"), k)
    return found.withColumn("score", -F.col("score")) if metric in LOWER_IS_BETTER else found
