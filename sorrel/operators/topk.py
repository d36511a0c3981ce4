"""Exact nearest items: one query against all, or every base against all items.

The many-to-many form hashes both sides into blocks of bounded size, brings each
pair of blocks together once and keeps only the best ``k`` per base from it, so the
pairs themselves are never rows. Scores are compared to 10 decimals and ties go to
the lower item id, which makes the order independent of how sums were evaluated.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sorrel.functions.similarity import METRICS
from sorrel.operators.joins import lookup_join
from sorrel.session import materialise, shuffle_partitions

BLOCK_ROWS = 16384
SMALLEST_BLOCK = 256
SLICE_SCORES = 1 << 22
PAIRS_PER_CORE = 4
EXCLUDED_PER_PAIR = 1 << 22
#: Pairs from which it pays to build an index for bounds.
PRUNE_PAIRS = 1 << 34
DIGITS = 10
LOWER_IS_BETTER = {"euclidean"}
_GROUP, _LEFT, _RIGHT = "_group", "_lb", "_rb"


def nearest_to_one(
    items: DataFrame, query: object, k: int, metric: str, id_col: str, vec_col: str, digits: int = DIGITS
) -> DataFrame:
    """The ``k`` items closest to item ``query``; no rows when it is unknown.

    Only the query's own vector reaches the driver; the items are scanned once and
    every task keeps its best ``k``.
    """
    source = items.where(F.col(vec_col).isNotNull())
    row = source.where(F.col(id_col) == F.lit(query)).select(vec_col).head()
    if row is None:
        return source.limit(0).select(F.col(id_col).alias("item"), F.lit(0.0).alias("score"))
    probe = F.lit([float(x) for x in row[0]]).cast("array<double>")
    score = METRICS[metric](F.col(vec_col), probe)
    scored = source.where(F.col(id_col) != F.lit(query)).select(F.col(id_col).alias("item"), score.alias("score"))
    key = F.round("score", digits)
    order = key.asc() if metric in LOWER_IS_BETTER else key.desc()
    return scored.where(~F.isnan("score")).orderBy(order, F.asc("item")).limit(k)


def _vectors(table: pa.Table) -> np.ndarray:
    column = table.column("vec").combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = column.chunk(0)
    lengths = np.unique(pc.list_value_length(column).to_numpy(zero_copy_only=False))
    if len(lengths) > 1:
        raise ValueError(f"vectors differ in length: {lengths.tolist()}")
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _unit(m: np.ndarray) -> np.ndarray:
    norms = np.sqrt((m * m).sum(axis=1, keepdims=True))
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where(norms == 0, np.nan, m / norms)


def _centred(m: np.ndarray) -> np.ndarray:
    centred = m - m.mean(axis=1, keepdims=True)
    flat = (m == m[:, :1]).all(axis=1)
    centred[flat] = 0.0
    return centred


def _prepared(metric: str, m: np.ndarray) -> np.ndarray:
    """Vectors whose dot product is the metric; rows without a direction become NaN."""
    if metric == "cosine":
        return _unit(m)
    if metric == "pearson":
        return _unit(_centred(m))
    if metric in ("dot", "euclidean", "adjusted_cosine"):
        return m
    raise ValueError(f"unknown metric: {metric}")


def _levels(m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows less their own mean, and the mean as a large and a small part.

    What is left keeps its precision at any level, as the small part holds the rounding of the large.
    """
    with np.errstate(invalid="ignore", over="ignore"):
        large = np.where((m == m[:, :1]).all(axis=1), m[:, 0], m.mean(axis=1))
        centred = m - large[:, None]
        small = centred.mean(axis=1)
        return centred - small[:, None], large, small


class _Scorer:
    """Scores of left rows against all right rows, higher is better.

    A matrix product gives every score to within ``margin``. For distances it comes
    from expanded squares, so the few candidates are worked out again by differences.
    For the adjusted cosine the rows lose their own means first. With ``h`` as half the
    difference of the two means it is ``(xy - nhh) / sqrt((xx + nhh) (yy + nhh))``, where
    nothing cancels in the norms, and the error is some ``n`` roundings at any level.
    """

    def __init__(self, metric: str, a: np.ndarray, b: np.ndarray):
        self.metric, self.a, self.b = metric, a, b
        self.far, self.adjusted = metric == "euclidean", metric == "adjusted_cosine"
        if self.adjusted:
            self.a, self.la, self.ra = _levels(a)
            self.b, self.lb, self.rb = _levels(b)
        if self.far or self.adjusted:
            self.aa, self.bb = (self.a * self.a).sum(axis=1), (self.b * self.b).sum(axis=1)

    def rough(self, at: int, to: int) -> np.ndarray:
        product = self.a[at:to] @ self.b.T
        if self.adjusted:
            # One mean over both vectors is taken off every component of either.
            with np.errstate(invalid="ignore", divide="ignore"):
                half = ((self.la[at:to, None] - self.lb) + (self.ra[at:to, None] - self.rb)) / 2
                square = self.a.shape[1] * half * half
                return (product - square) / np.sqrt((self.aa[at:to, None] + square) * (self.bb + square))
        if not self.far:
            return product
        product *= 2
        product -= self.aa[at:to, None]
        product -= self.bb[None, :]
        return product

    def margin(self, kth: np.ndarray) -> np.ndarray | float:
        if self.adjusted:
            return 10.0 ** (1 - DIGITS) + 1e-14 * self.a.shape[1]
        if not self.far:
            return 10.0 ** (1 - DIGITS)
        size = max(self.aa.max(initial=0.0), self.bb.max(initial=0.0))
        reach = np.sqrt(np.maximum(-np.where(np.isfinite(kth), kth, 0.0), 0.0))
        return 4e-15 * self.a.shape[1] * size + (2 * reach + 1e-9) * 10.0 ** (1 - DIGITS)

    def exact(self, rough: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rounded scores of single pairs."""
        if self.adjusted:
            return self._exact_adjusted(rough, left, right)
        if not self.far:
            return np.round(rough, DIGITS)
        out = np.full(len(rough), -np.inf)
        for at in range(0, len(rough), 1 << 16):
            part = slice(at, at + (1 << 16))
            step = self.a[left[part]] - self.b[right[part]]
            out[part] = -np.round(np.sqrt(np.einsum("ij,ij->i", step, step)), DIGITS)
        out[~np.isfinite(rough)] = -np.inf
        return out


    def _exact_adjusted(self, rough: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        out = np.full(len(rough), -np.inf)
        for at in range(0, len(rough), 1 << 16):
            part = slice(at, at + (1 << 16))
            i, j = left[part], right[part]
            half = (((self.la[i] - self.lb[j]) + (self.ra[i] - self.rb[j])) / 2)[:, None]
            x, y = self.a[i] + half, self.b[j] - half
            norms = np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1))
            with np.errstate(invalid="ignore", divide="ignore"):
                out[part] = np.round((x * y).sum(axis=1) / norms, DIGITS)
        out[~np.isfinite(rough) | ~np.isfinite(out)] = -np.inf
        return out


def _first_level(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Best ``k`` places per row of rounded scores; equal scores go to earlier columns."""
    kth = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k, None]
    above = scores > kth
    level = scores == kth
    room = k - above.sum(axis=1, keepdims=True)
    level &= np.cumsum(level, axis=1, dtype=np.int32) <= room
    return np.nonzero(above | level)


def _best(scores: np.ndarray, k: int, scorer: _Scorer, exact) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places and exact scores that hold the best ``k`` per row, perhaps with a few more.

    Usually only the scores down to a little below the k-th need to be exact. Where
    many are that close, as among copies, all of them are worked out.
    """
    width = scores.shape[1]
    k = min(k, width)
    kth = np.partition(scores, width - k, axis=1)[:, width - k, None]
    rows, cols = np.nonzero(scores >= kth - scorer.margin(kth))
    if len(rows) <= 4 * k * len(scores):
        values = exact(scores[rows, cols], rows, cols)
    else:
        rows, cols = (x.ravel() for x in np.indices(scores.shape, dtype=np.int32))
        whole = exact(scores.ravel(), rows, cols).reshape(scores.shape)
        rows, cols = _first_level(whole, k)
        values = whole[rows, cols]
    real = np.isfinite(values)
    return rows[real], cols[real], values[real]


def _trim(base: np.ndarray, item: np.ndarray, value: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The best ``k`` of the candidates of each base."""
    order = np.lexsort((item, -value, base))
    base, item, value = base[order], item[order], value[order]
    starts = np.flatnonzero(np.r_[True, base[1:] != base[:-1]]) if len(base) else np.empty(0, dtype=int)
    rank = np.arange(len(base)) - np.repeat(starts, np.diff(np.r_[starts, len(base)]))
    keep = rank < k
    return base[keep], item[keep], value[keep]


def _pair_kernel(metric: str, k: int, exclude_self: bool, both_ways: bool, schema: pa.Schema):
    def compare(key, left: pa.Table, right: pa.Table) -> pa.Table:
        left, right = left.sort_by("id"), right.sort_by("id")
        seen = left.filter(pc.is_valid(left.column("other")))
        left = left.filter(pc.is_null(left.column("other")))
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        group, lb, rb = (part.as_py() for part in key)
        a, b = _prepared(metric, _vectors(left)), _prepared(metric, _vectors(right))
        if a.shape[1] != b.shape[1]:
            raise ValueError(f"vectors differ in length: {a.shape[1]} and {b.shape[1]}")
        lid, rid = left.column("id").to_numpy(), right.column("id").to_numpy()
        seen_row = seen_col = np.empty(0, dtype=int)
        if seen.num_rows:
            base, item = seen.column("id").to_numpy(), seen.column("other").to_numpy()
            r = np.minimum(np.searchsorted(lid, base), len(lid) - 1)
            c = np.minimum(np.searchsorted(rid, item), len(rid) - 1)
            hit = (lid[r] == base) & (rid[c] == item)
            seen_row, seen_col = r[hit], c[hit]
        bad_row, bad_col = ~np.isfinite(a).all(axis=1), ~np.isfinite(b).all(axis=1)
        own = np.searchsorted(rid, lid) if exclude_self else None
        scorer = _Scorer(metric, a, b)
        forward, backward = [], []
        step = max(1, SLICE_SCORES // len(rid))
        for at in range(0, len(lid), step):
            ids = lid[at : at + step]
            scores = scorer.rough(at, at + step)
            scores[bad_row[at : at + step]] = -np.inf
            scores[np.isnan(scores)] = -np.inf
            scores[:, bad_col] = -np.inf
            if exclude_self:
                place = np.minimum(own[at : at + step], len(rid) - 1)
                same = np.flatnonzero(rid[place] == ids)
                scores[same, place[same]] = -np.inf
            here = (seen_row >= at) & (seen_row < at + step)
            scores[seen_row[here] - at, seen_col[here]] = -np.inf
            rows, cols, values = _best(scores, k, scorer, lambda s, r, c: scorer.exact(s, r + at, c))
            forward.append((ids[rows], rid[cols], values))
            if both_ways and lb != rb:
                turned = np.ascontiguousarray(scores.T)
                cols, rows, values = _best(turned, k, scorer, lambda s, c, r: scorer.exact(s, r + at, c))
                backward.append((rid[cols], ids[rows], values))
        sides = [_trim(*(np.concatenate(parts) for parts in zip(*side)), k) for side in (forward, backward) if side]
        found = [np.concatenate(parts) for parts in zip(*sides)]
        groups = np.full(len(found[0]), group, dtype=np.int64)
        return pa.table([pa.array(x) for x in (groups, *found)], schema=schema)

    return compare


def _blocks(rows: int, parallelism: int) -> int:
    """Blocks for ``rows`` vectors: bounded in size, and enough pairs to keep tasks busy."""
    by_size = math.ceil(rows / BLOCK_ROWS)
    by_work = min(math.ceil(rows / SMALLEST_BLOCK), math.ceil(math.sqrt(2 * PAIRS_PER_CORE * parallelism)))
    return max(1, by_size, by_work)


def top_matches(
    base: DataFrame,
    items: DataFrame | None,
    k: int,
    metric: str,
    id_col: str,
    vec_col: str,
    group_col: str | None = None,
    exclude_self: bool = True,
    exclude: DataFrame | None = None,
    prune: bool = True,
) -> DataFrame:
    """Best ``k`` items per base as ``(base, item, score, rank)`` rows.

    ``items=None`` compares ``base`` with itself, visiting each pair of blocks once.
    ``group_col`` (integer) restricts matches to the same group; a large group is cut
    into more blocks. ``exclude`` holds ``(base, item)`` pairs that must not appear.
    Ids are integers, unique per side; rows without an id or a vector are left out.
    From ``PRUNE_PAIRS`` pairs on, bounds are tried first (``pruned``), which give the same rows.
    """
    spark = base.sparkSession
    parallelism = spark.sparkContext.defaultParallelism
    self_join = items is None
    if exclude is not None and (group_col or self_join):
        raise ValueError("exclude needs an ungrouped comparison with items")

    def shaped(df: DataFrame) -> DataFrame:
        group = F.col(group_col).cast("bigint") if group_col else F.lit(0).cast("bigint")
        return df.where(F.col(vec_col).isNotNull() & F.col(id_col).isNotNull()).select(
            group.alias(_GROUP),
            F.col(id_col).cast("bigint").alias("id"),
            F.col(vec_col).alias("vec"),
        )

    def by_bounds(pairs: float) -> DataFrame | None:
        from sorrel.operators import pruned

        known = metric in pruned.METRICS and not (group_col and (metric == "dot" or not self_join))
        if not (prune and known and pairs >= PRUNE_PAIRS):
            return None
        return pruned.top_matches_pruned(base, items, k, metric, id_col, vec_col, group_col, exclude_self, exclude)

    left, right = shaped(base), shaped(base if self_join else items)
    if group_col:
        left, right, pairs, work = _grouped_blocks(left, right, self_join)
        if (bounded := by_bounds(work)) is not None:
            return bounded
    else:
        n_left = left.count()
        n_right = n_left if self_join else right.count()
        if (bounded := by_bounds(n_left * n_right)) is not None:
            return bounded
        nl = _blocks(n_left, parallelism)
        nr = nl if self_join else _blocks(n_right, parallelism)
        if exclude is not None:
            crowd = math.sqrt(exclude.count() / (EXCLUDED_PER_PAIR * nl * nr))
            nl, nr = (math.ceil(n * max(1.0, crowd)) for n in (nl, nr))
        pairs = nl * (nl + 1) // 2 if self_join else nl * nr
        sizes = [F.lit(nl).alias("_nl"), F.lit(nr).alias("_nr")]
        left, right = left.select("*", *sizes), right.select("*", *sizes)

    lb = F.pmod(F.xxhash64("id"), F.col("_nl")).cast("int")
    rb = F.pmod(F.xxhash64("id"), F.col("_nr")).cast("int")
    zero, last_l, last_r = F.lit(0), (F.col("_nl") - 1).cast("int"), (F.col("_nr") - 1).cast("int")
    left = left.withColumn(_LEFT, lb)
    right = right.withColumn(_RIGHT, rb)
    if self_join:
        left = left.withColumn(_RIGHT, F.explode(F.sequence(F.col(_LEFT), last_r)))
        right = right.withColumn(_LEFT, F.explode(F.sequence(zero, F.col(_RIGHT))))
    else:
        left = left.withColumn(_RIGHT, F.explode(F.sequence(zero, last_r)))
        right = right.withColumn(_LEFT, F.explode(F.sequence(zero, last_l)))
    columns = [_GROUP, _LEFT, _RIGHT, "id", "vec"]
    left = left.select(*columns, F.lit(None).cast("bigint").alias("other"))
    right = right.select(*columns)
    if exclude is not None:
        left = left.unionByName(
            exclude.select(
                F.lit(0).cast("bigint").alias(_GROUP),
                F.pmod(F.xxhash64(F.col("base").cast("bigint")), F.lit(nl)).cast("int").alias(_LEFT),
                F.pmod(F.xxhash64(F.col("item").cast("bigint")), F.lit(nr)).cast("int").alias(_RIGHT),
                F.col("base").cast("bigint").alias("id"),
                F.lit(None).cast(left.schema["vec"].dataType).alias("vec"),
                F.col("item").cast("bigint").alias("other"),
            )
        )
    keys = [_GROUP, _LEFT, _RIGHT]
    tasks = max(1, min(pairs, max(shuffle_partitions(spark), pairs // 16)))
    schema = pa.schema([(_GROUP, pa.int64()), ("base", pa.int64()), ("item", pa.int64()), ("score", pa.float64())])
    kernel = _pair_kernel(metric, k, exclude_self, self_join, schema)
    found = (
        left.repartition(tasks, *keys)
        .groupBy(*keys)
        .cogroup(right.repartition(tasks, *keys).groupBy(*keys))
        .applyInArrow(kernel, f"{_GROUP} bigint, base bigint, item bigint, score double")
    )
    if group_col:
        found = found.withColumnRenamed(_GROUP, group_col)
    else:
        found = found.drop(_GROUP)
    ranked = keep_best(found, k)
    return ranked.withColumn("score", -F.col("score")) if metric in LOWER_IS_BETTER else ranked


def _grouped_blocks(left: DataFrame, right: DataFrame, self_join: bool) -> tuple[DataFrame, DataFrame, int, float]:
    """Attaches the number of blocks per group; groups are cut alike, by the total work, which comes last."""

    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(_GROUP).agg(F.count(F.lit(1)).alias(name))

    if self_join:
        counts = counted(left, "_cl").withColumn("_cr", F.col("_cl"))
    else:
        counts = counted(left, "_cl").join(counted(right, "_cr"), _GROUP)
    counts = materialise(counts)
    cores = left.sparkSession.sparkContext.defaultParallelism
    work = counts.agg(F.sum(F.col("_cl").cast("double") * F.col("_cr"))).head()[0] or 0.0
    edge = int(min(BLOCK_ROWS, max(SMALLEST_BLOCK, math.sqrt(work / (PAIRS_PER_CORE * cores)))))
    sizes = counts.select(
        _GROUP, F.ceil(F.col("_cl") / edge).cast("int").alias("_nl"), F.ceil(F.col("_cr") / edge).cast("int").alias("_nr")
    )
    per_group = F.col("_nl").cast("bigint") * (F.col("_nl") + 1) / 2 if self_join else F.col("_nl").cast("bigint") * F.col("_nr")
    pairs = int(sizes.agg(F.sum(per_group)).head()[0] or 1)
    return lookup_join(left, sizes, [_GROUP], ["id"]), lookup_join(right, sizes, [_GROUP], ["id"]), pairs, work


def keep_best(found: DataFrame, k: int) -> DataFrame:
    """Best ``k`` rows per base, higher score first, then lower item id."""
    order = Window.partitionBy("base").orderBy(F.desc("score"), F.asc("item"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def as_lists(bases: DataFrame, ranked: DataFrame) -> DataFrame:
    """One row per base with its list, empty when nothing matched; lists hold at most k entries."""
    lists = ranked.groupBy("base").agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("rank", "item", "score"))),
            lambda e: F.struct(e["item"].alias("item"), e["score"].alias("sim")),
        ).alias("entries")
    )
    empty = F.array().cast("array<struct<item:bigint,sim:double>>")
    return bases.select("base").join(lists, "base", "left").select("base", F.coalesce("entries", empty).alias("entries"))


def as_rows(lists: DataFrame) -> DataFrame:
    """Lists back to ``(base, item, score, rank)`` rows."""
    entries = lists.select("base", F.posexplode_outer("entries").alias("_pos", "_entry"))
    return entries.where(F.col("_entry").isNotNull()).select(
        "base",
        F.col("_entry.item").alias("item"),
        F.col("_entry.sim").alias("score"),
        (F.col("_pos") + 1).alias("rank"),
    )
