"""K-means by Lloyd steps with distance bounds, seeded by hashes.

Every item keeps its cluster, an upper bound on the distance to its centre and a lower bound on the
distance to any other. When the centres have moved, the bounds move with them, and only an item whose bounds
cross is measured again: first against its own centre, then, if need be, against all. Results are
those of plain Lloyd steps. Draws come from hashes of ids, so that neither the partitioning nor a repeated
task changes them; centres are few and go to every task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from sorrel.operators.topk import _vectors
from sorrel.session import materialise

#: Steps between reliable checkpoints; the steps between are kept by the executors and can be worked out again.
CHECKPOINT = 5
ROUNDS = 4
STATE = "id bigint, vec array<double>, cluster int, upper double, lower double, measured int"


@dataclass
class Centres:
    """Centres after a number of steps, the cost of the items with them, and the distances worked out until then."""

    centres: np.ndarray
    iterations: int
    cost: float
    measured: int
    assigned: DataFrame


def hash_unit(ids: Column, name: str) -> Column:
    """A number from 0 to 1, from a hash of a name and the id."""
    text = F.concat(F.lit(f"{name}-"), ids.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def hash_seeds(items: DataFrame, k: int, seed: int = 42) -> np.ndarray:
    """The vectors of the ``k`` items whose hashes are least."""
    chosen = items.select("id", "vec", hash_unit(F.col("id"), f"kmeans-{seed}").alias("h")).orderBy("h", "id").limit(k)
    return _vectors(chosen.toArrow().select(["vec"]))


def parallel_seeds(items: DataFrame, k: int, seed: int = 42, rounds: int = ROUNDS) -> np.ndarray:
    """k-means||: a few rounds draw some ``2 k`` items each, far ones likelier; of these, ``k`` are kept by weight and distance."""
    found = hash_seeds(items, 1, seed)
    for n in range(rounds):
        far = F.col("upper") * F.col("upper")
        nearest = _measured(items, found)
        total = nearest.agg(F.sum(far)).head()[0] or 0.0
        if total <= 0:
            break
        drawn = hash_unit(F.col("id"), f"kmeans-{seed}-{n}") < 2 * k * far / F.lit(total)
        # 2 k items on average.
        more = nearest.where(drawn).select("id", "vec").toArrow()
        if more.num_rows:
            found = np.concatenate([found, _vectors(more.sort_by("id").select(["vec"]))])
    weights = np.zeros(len(found))
    for r in _measured(items, found).groupBy("cluster").count().collect():
        weights[r["cluster"]] = r["count"]
    chosen = [int(weights.argmax())]
    away = ((found - found[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < min(k, len(found)):
        chosen.append(int((weights * away).argmax()))
        away = np.minimum(away, ((found - found[chosen[-1]]) ** 2).sum(axis=1))
    return found[chosen]


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances by differences, so that equal vectors are at zero."""
    out = np.empty((len(a), len(b)))
    for j in range(len(b)):
        out[:, j] = ((a - b[j]) ** 2).sum(axis=1)
    return out


def _two_nearest(vectors: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The nearest centre, the lower one on ties, its distance, and the distance of the next."""
    away = np.sqrt(_squares(vectors, centres))
    nearest = away.argmin(axis=1)
    rows = np.arange(len(vectors))
    upper = away[rows, nearest]
    away[rows, nearest] = np.inf
    return nearest, upper, away.min(axis=1)


def _state(batch: pa.RecordBatch, cluster, upper, lower, measured) -> pa.RecordBatch:
    arrays = [batch.column("id"), batch.column("vec"), pa.array(cluster.astype(np.int32)), pa.array(upper), pa.array(lower),
              pa.array(measured.astype(np.int32))]
    return pa.RecordBatch.from_arrays(arrays, names=["id", "vec", "cluster", "upper", "lower", "measured"])


def _measured(items: DataFrame, centres: np.ndarray) -> DataFrame:
    """Every item with its nearest centre, all distances worked out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                nearest, upper, lower = _two_nearest(_vectors(pa.Table.from_batches([batch])), centres)
                yield _state(batch, nearest, upper, lower, np.full(len(nearest), len(centres)))

    return items.select("id", "vec").mapInArrow(run, STATE)


def _moved(state: DataFrame, centres: np.ndarray, moves: np.ndarray) -> DataFrame:
    """The state for moved centres; distances only where the bounds cross."""
    between = np.sqrt(_squares(centres, centres))
    np.fill_diagonal(between, np.inf)
    # No other centre can be nearer to an item that is within half the way to the next one.
    half, most = between.min(axis=1) / 2, np.sort(moves)[::-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _vectors(pa.Table.from_batches([batch]))
            cluster, upper, lower = (batch.column(c).to_numpy().copy() for c in ("cluster", "upper", "lower"))
            # A little more than the moves, so that rounding never hides a crossing; ties are measured as well.
            upper += moves[cluster] + 1e-12 * (1 + upper)
            other = np.where(moves[cluster] == most[0], most[1] if len(most) > 1 else 0.0, most[0])
            lower -= other + 1e-12 * (1 + np.abs(lower))
            bound = np.maximum(half[cluster], lower)
            measured = np.zeros(len(cluster), np.int64)
            loose = np.flatnonzero(upper >= bound)
            upper[loose] = np.sqrt(((vectors[loose] - centres[cluster[loose]]) ** 2).sum(axis=1))
            measured[loose] += 1
            crossed = loose[upper[loose] >= bound[loose] * (1 - 1e-12)]
            if len(crossed):
                cluster[crossed], upper[crossed], lower[crossed] = _two_nearest(vectors[crossed], centres)
                measured[crossed] += len(centres)
            yield _state(batch, cluster, upper, lower, measured)

    return state.mapInArrow(run, STATE)


def _means(state: DataFrame, centres: np.ndarray) -> np.ndarray:
    """Mean of each cluster; an empty one keeps its centre. Sums combine in the tasks."""
    mean = vector_to_array(Summarizer.mean(array_to_vector("vec"))).alias("m")
    new = centres.copy()
    for r in state.groupBy("cluster").agg(mean).collect():  # one row per cluster
        new[r["cluster"]] = r["m"]
    return new


def lloyd(items: DataFrame, centres: np.ndarray, iterations: int, record: Sequence[int] = ()) -> list[Centres]:
    """Steps from the given centres, with results after those of ``record`` and after the last one.

    Ends early when no centre moves; later records are then equal.
    """
    state = materialise(_measured(items, centres))
    out, measured = [], 0
    asked = sorted({*record, iterations})
    held = None
    for n in range(1, iterations + 1):
        measured += state.agg(F.sum("measured")).head()[0] or 0
        new = _means(state, centres)
        moves = np.sqrt(((new - centres) ** 2).sum(axis=1))
        centres = new
        still = not moves.any()
        if not still:
            following = _moved(state, centres, moves)
            if n % CHECKPOINT == 0:
                following, keep = materialise(following), None
            else:
                following = keep = following.persist(StorageLevel.DISK_ONLY)
                following.count()
            if held is not None:
                held.unpersist()
            state, held = following, keep
        for _ in [a for a in asked if a == n or (still and a > n)]:
            out.append(_result(state, centres, asked[len(out)], measured))
        if still:
            break
    return out


def _result(state: DataFrame, centres: np.ndarray, iterations: int, measured: int) -> Centres:
    """Cost with the final centres; the bounds of items that were not measured say only which centre is nearest."""
    middle = F.lit(centres.tolist())
    squares = F.aggregate(F.zip_with("vec", F.get(middle, F.col("cluster")), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)
    assigned = materialise(state.select("id", "cluster", squares.alias("square")))
    return Centres(centres, iterations, assigned.agg(F.sum("square")).head()[0] or 0.0, measured, assigned)


def prepared(items: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    known = items.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull())
    return materialise(known.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).cast("array<double>").alias("vec")))


def grid_search(
    items: DataFrame, id_col: str, vec_col: str, ks: Sequence[int], iterations: Sequence[int], seed: int = 42, seeds=parallel_seeds
) -> tuple[Centres, DataFrame]:
    """Best centres by cost, then fewer clusters, then fewer steps; and the costs. The steps of a ``k`` are one run."""
    data, points = prepared(items, id_col, vec_col), []
    for k in sorted(ks):
        for found in lloyd(data, seeds(data, k, seed), max(iterations), iterations):
            points.append((k, found))
    best = min(range(len(points)), key=lambda i: (points[i][1].cost, i))
    rows = [Row(k=k, iterations=c.iterations, cost=float(c.cost), best=i == best) for i, (k, c) in enumerate(points)]
    return points[best][1], items.sparkSession.createDataFrame(rows, "k int, iterations int, cost double, best boolean")
