"""Exact top-k inner-product search by ball trees with branch and bound.

Candidate vectors are dealt into shards of bounded size and each shard gets a ball tree over
its integer vectors. A query visits the nodes of a tree in order of their upper bound on the
inner product, ``q . centre + |q| * radius``, and leaves the tree as soon as no bound reaches
its current k-th score. A tree is built once, where the candidates of its shard are, and the
queries stream past it in Arrow batches. The k-th scores are shared: a first pass answers every query
from a few seed vectors spread over all shards, the first eighth of the shards starts from these scores
and hands on better ones, and all other shards start from those. Only ``k`` rows per query and shard
leave a shard.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sorrel.llm.common import shuffle_partitions, stored

SCALE = 256
SHARD_ROWS = 16_384
LEAST_SHARD = 1_024
#: Queries that search a tree at a time.
QUERY_ROWS = 1_024
#: The share of shards that goes first is one in so many.
FIRST_SHARDS = 8
#: Seed vectors of the first pass.
SEEDS = 2_048
LEAF = 64
EXACT = 2.0**52
LONG = 2**63 - 1


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``(vec_id, v)`` with ``floor(scale * x)``; rows with a null, non-finite or no component drop out."""
    whole = F.transform("embedding", lambda x: x.cast("double"))
    fine = F.forall("_x", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    rows = vectors.select("vec_id", whole.alias("_x")).where("vec_id is not null and _x is not null").where(fine)
    return rows.where(F.size("_x") > 0).select("vec_id", F.transform("_x", lambda x: F.floor(x * scale)).alias("v"))


class BallTree:
    """Nodes as arrays: slice of the vectors, centre, radius and children."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF):
        self.nodes: list[tuple[int, int, int, int]] = []
        self.centres, self.radii = [], []
        self.order = np.arange(len(ids))
        self._build(vectors, leaf)
        self.ids, self.vectors = ids[self.order], vectors[self.order]
        self.centres, self.radii = np.array(self.centres), np.array(self.radii)

    def _build(self, vectors: np.ndarray, leaf: int) -> None:
        waiting = [(0, len(self.order), -1, 0)]
        while waiting:
            start, stop, parent, side = waiting.pop()
            part = vectors[self.order[start:stop]]
            centre = part.mean(axis=0)
            away = np.sqrt(((part - centre) ** 2).sum(axis=1))
            number = len(self.nodes)
            self.nodes.append((start, stop, -1, -1))
            self.centres.append(centre)
            # Rounded up, so that a bound never falls below a score.
            self.radii.append(away.max() * (1 + 1e-9) + 1e-9)
            if parent >= 0:
                s, t, left, right = self.nodes[parent]
                self.nodes[parent] = (s, t, number, right) if side == 0 else (s, t, left, number)
            if stop - start <= leaf or away.max() == 0:
                continue
            # Split between the vector farthest from the centre and the one farthest from that.
            one = part[away.argmax()]
            other = part[((part - one) ** 2).sum(axis=1).argmax()]
            along = np.argsort(part @ (other - one), kind="stable")
            self.order[start:stop] = self.order[start:stop][along]
            middle = (start + stop) // 2
            waiting += [(start, middle, number, 0), (middle, stop, number, 1)]

    def search(self, queries: np.ndarray, own: np.ndarray, floors: np.ndarray, k: int) -> Iterator[tuple[int, int, int]]:
        """``(query position, vec_id, score)`` of each query's ``k`` best with score at least its floor."""
        norms = np.sqrt((queries**2).sum(axis=1))
        bounds = queries @ self.centres.T + norms[:, None] * self.radii
        bounds += 1e-9 * (1 + np.abs(bounds))
        for q in range(len(queries)):
            bound, floor = bounds[q], floors[q]
            ids, scores = np.zeros(0, np.int64), np.zeros(0)
            heap = [(-bound[0], 0)]
            while heap:
                upper, node = heapq.heappop(heap)
                if -upper < floor:
                    break
                start, stop, left, right = self.nodes[node]
                if left >= 0:
                    for child in (left, right):
                        if bound[child] >= floor:
                            heapq.heappush(heap, (-bound[child], child))
                    continue
                found = self.vectors[start:stop] @ queries[q]
                fits = (found >= floor) & (self.ids[start:stop] != own[q])
                if fits.any():
                    ids = np.concatenate([ids, self.ids[start:stop][fits]])
                    scores = np.concatenate([scores, found[fits]])
                    best = np.lexsort((ids, -scores))[:k]
                    ids, scores = ids[best], scores[best]
                    if len(ids) == k:
                        floor = max(floor, scores[-1])
            yield from ((q, int(i), int(s)) for i, s in zip(ids, scores))


def _exact_scores(ids, vectors, queries, own, k):
    """For components so large that doubles could round: whole numbers of any size, kept within a long."""
    wide = vectors.astype(object)
    for q in range(len(queries)):
        scores = wide @ queries[q].astype(object)
        found = sorted((-s, int(i)) for s, i in zip(scores, ids) if i != own[q])[:k]
        yield from ((q, i, max(-LONG - 1, min(LONG, -s))) for s, i in found)


def _matrix(rows: pa.Table) -> np.ndarray:
    column = rows.column("v").combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows.num_rows, -1)


class Shard:
    """The candidates of one shard, and their tree, which is built when the first query needs it."""

    def __init__(self, rows: pa.Table):
        self.ids, self.vectors = rows.column("id").to_numpy(), _matrix(rows)
        self.largest = float(np.abs(self.vectors.astype(np.float64)).max())
        self.tree: BallTree | None = None

    def search(self, rows: pa.Table, k: int) -> Iterator[tuple[int, int, int]]:
        """``(query id, vec_id, score)`` of the best candidates for some queries."""
        own, queries = rows.column("id").to_numpy(), _matrix(rows)
        largest = self.largest * float(np.abs(queries.astype(np.float64)).max())
        if largest * queries.shape[1] < EXACT:
            self.tree = self.tree or BallTree(self.ids, self.vectors.astype(np.float64))
            floors = pc.fill_null(rows.column("floor"), -np.inf).to_numpy()
            found = self.tree.search(queries.astype(np.float64), own, floors, k)
        else:
            found = _exact_scores(self.ids, self.vectors, queries, own, k)
        return ((int(own[q]), i, s) for q, i, s in found)


def _past_trees(k: int, query_rows: int):
    """Rows sorted by shard, with the candidates of a shard before its queries."""
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, shard = None, [], None
        for batch in batches:
            marks = np.stack([batch.column(c).to_numpy() for c in ("_length", "_shard", "kind")])
            cuts = np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1
            for a, b in zip(np.r_[0, cuts], np.r_[cuts, batch.num_rows]):
                if a == b:
                    continue
                if (now := tuple(marks[:2, a].tolist())) != key:
                    key, held, shard = now, [], None
                if marks[2, a] == 0:
                    held.append(batch.slice(a, b - a))
                    continue
                if shard is None and held:
                    shard, held = Shard(pa.Table.from_batches(held)), []
                for start in range(a, b if shard is not None else a, query_rows):
                    found = list(shard.search(pa.Table.from_batches([batch.slice(start, min(query_rows, b - start))]), k))
                    if found:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], schema=schema)

    return run


def _meet(candidates: DataFrame, queries: DataFrame, low: int, high: int, k: int, query_rows: int) -> DataFrame:
    """All queries past the trees of shards ``low`` to ``high - 1`` of candidates of their length."""
    held = candidates.where(F.col("_shard").between(low, high - 1)).select(
        "_length", "_shard", F.lit(0).alias("kind"), F.col("vec_id").alias("id"), "v", F.lit(None).cast("double").alias("floor")
    )
    asked = queries.select(
        "_length", F.explode(F.sequence(F.lit(low), F.lit(high - 1))).alias("_shard"), F.lit(1).alias("kind"),
        F.col("query_id").alias("id"), F.col("q").alias("v"), "floor",
    )
    n = shuffle_partitions(candidates.sparkSession)
    dealt = held.unionByName(asked).repartition(n, "_length", "_shard").sortWithinPartitions("_length", "_shard", "kind", "id")
    return dealt.mapInArrow(_past_trees(k, query_rows), "query_id long, vec_id long, score long")


def best_of(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def kth_scores(found: DataFrame, k: int) -> DataFrame:
    return best_of(found, k).where(F.col("rank") == k).select("query_id", F.col("score").cast("double").alias("floor"))


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 5, scale: int = SCALE, shard_rows: int = SHARD_ROWS,
    query_rows: int = QUERY_ROWS, seeds: int = SEEDS,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query's ``k`` best candidates, ties to the smaller id.

    Candidates are all rows but those with the query's own id; only vectors of equal length are compared.
    Queries of a repeated id are answered once, by the smallest such vector; a repeated candidate counts as
    often as it occurs. Scores beyond a long are kept at its ends. Empty tables give an empty result.
    """
    rows = stored(quantised(vectors, scale).withColumn("_length", F.size("v")))
    total = rows.count()
    shards = max(1, -(-total // shard_rows), min(shuffle_partitions(rows.sparkSession), -(-total // LEAST_SHARD)))
    # Dealt by place in the stored table, so that a repeated id spreads as well.
    spread = F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(shards)).cast("int")
    candidates = rows.withColumn("_shard", spread)
    queries = rows.where(is_query).groupBy("vec_id").agg(F.min(F.struct("_length", "v")).alias("_q"))
    queries = stored(queries.select(
        F.col("vec_id").alias("query_id"), F.col("_q.v").alias("q"), F.col("_q._length").alias("_length")
    ))
    # The k-th score among the seeds bounds every query from below before it enters a shard.
    taken = F.pmod(F.xxhash64("vec_id", F.lit("seed")), F.lit(1_000_000)) < int(1e6 * min(1.0, seeds / max(1, total)))
    seeded = candidates.where(taken).withColumn("_shard", F.lit(0))
    floors = stored(kth_scores(_meet(seeded, queries.withColumn("floor", F.lit(None).cast("double")), 0, 1, k, query_rows), k))
    first = -(-shards // FIRST_SHARDS) if shards >= FIRST_SHARDS else shards
    best = None
    for low, high in ((0, first), (first, shards)):
        if low == high:
            continue
        found = _meet(candidates, queries.join(floors, "query_id", "left"), low, high, k, query_rows)
        best = stored(best_of(found if best is None else found.unionByName(best.drop("rank")), k))
        floors = floors.unionByName(kth_scores(best.drop("rank"), k)).groupBy("query_id").agg(F.max("floor").alias("floor"))
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
