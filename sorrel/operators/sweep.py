"""Locate addresses by a sweep: overlapping ranges become disjoint segments once, addresses are filled from them.

The addresses are cut into chunks by quantiles of the range starts and of the addresses looked up. A range
gives a piece to the chunk it starts in and one to the chunk it ends in; the chunks in between, which it
covers whole, it names as aligned blocks of chunks, of which only the best range is kept. So open ranges
are handed on to later chunks without a copy per chunk. Each chunk is then swept on its own: pieces are
painted in the order of their priority over what is still free. For the lookup, segments and addresses of a
chunk are sorted together, and every address takes the last segment that began before it: one row per
address, and no equality keys.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sorrel.operators.joins import lookup_join
from sorrel.operators.ranges import ADDRESS_BITS, numbered_ranges
from sorrel.session import materialise, shuffle_partitions

#: Ranges and addresses of a chunk aimed at, and the most chunks.
CHUNK_ROWS, MOST_CHUNKS = 1 << 18, 1 << 14
PIECE = "kind int, chunk bigint, start bigint, end bigint, priority bigint"


def _cuts(starts: DataFrame, addresses: DataFrame, ip: str) -> np.ndarray:
    """First addresses of all chunks but the first."""
    both = ((starts, "start"), (addresses.where(F.col(ip).between(0, (1 << ADDRESS_BITS) - 1)), ip))
    found = [np.zeros(0, np.int64)]
    for frame, column in both:
        parts = min(MOST_CHUNKS // 2, max(shuffle_partitions(frame.sparkSession), -(-frame.count() // CHUNK_ROWS)))
        places = frame.approxQuantile(column, [i / parts for i in range(1, parts)], 1 / (4 * parts)) if parts > 1 else []
        found.append(np.array(places, np.int64))
    cuts = np.unique(np.concatenate(found))
    return cuts[cuts > 0]


def _pieces(cuts: np.ndarray):
    """The ends of every range as pieces (kind 0), and what it covers whole as aligned blocks of chunks (kind 1)."""
    edges = np.concatenate(([0], cuts, [1 << ADDRESS_BITS]))
    schema = pa.schema([("kind", pa.int32()), *[(c, pa.int64()) for c in ("chunk", "start", "end", "priority")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, end, priority = (batch.column(c).to_numpy() for c in ("start", "end", "priority"))
            first, last = np.searchsorted(cuts, start, "right"), np.searchsorted(cuts, end, "right")
            wide = np.flatnonzero(last > first)
            rows = [
                (0, first, start, np.minimum(end, edges[first + 1] - 1), priority),
                (0, last[wide], edges[last[wide]], end[wide], priority[wide]),
            ]
            # Blocks of 2 ** level chunks between both ends, from the fine ones outwards.
            low, high, left, level = first[wide] + 1, last[wide], wide, 0
            while len(left):
                odd, even = low % 2 == 1, high % 2 == 1
                for taken, block in ((odd & (low < high), low), (even & (low < high), high - 1)):
                    at = np.flatnonzero(taken & (block >= low) & (block < high))
                    rows.append((1, block[at], np.full(len(at), level), np.zeros(len(at), np.int64), priority[left[at]]))
                low, high = (low + 1) // 2, high // 2
                on = low < high
                low, high, left, level = low[on], high[on], left[on], level + 1
            for kind, *columns in rows:
                if len(columns[0]):
                    arrays = [pa.array(np.full(len(columns[0]), kind, np.int32)), *[pa.array(c.astype(np.int64)) for c in columns]]
                    yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return run


def paint(start: np.ndarray, end: np.ndarray, priority: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Disjoint segments with the least priority that covers them, neighbours of one range joined."""
    points = np.unique(np.concatenate([start, end + 1]))
    best, free = np.full(len(points), np.iinfo(np.int64).max), list(range(len(points) + 1))
    order = np.argsort(priority, kind="stable")
    for a, b, p in zip(np.searchsorted(points, start)[order].tolist(), np.searchsorted(points, end + 1)[order].tolist(), priority[order].tolist()):
        while True:
            at = a
            while free[at] != at:  # to the next interval that nothing covers yet
                free[at] = free[free[at]]
                at = free[at]
            if at >= b:
                break
            best[at], free[at], a = p, at + 1, at + 1
    covered = best[:-1] != np.iinfo(np.int64).max
    low, high, best = points[:-1][covered], points[1:][covered] - 1, best[:-1][covered]
    fresh = np.ones(len(low), bool)
    fresh[1:] = (best[1:] != best[:-1]) | (low[1:] != high[:-1] + 1)
    at = np.flatnonzero(fresh)
    return low[at], high[np.append(at[1:], len(low)) - 1] if len(at) else high[:0], best[at]


def segments(numbered: DataFrame, cuts: np.ndarray) -> DataFrame:
    """``(chunk, start, end, priority)``: disjoint, and none of them in two chunks."""
    spark = numbered.sparkSession
    edges = np.concatenate(([0], cuts, [1 << ADDRESS_BITS]))
    pieces = materialise(numbered.select("start", "end", "priority").mapInArrow(_pieces(cuts), PIECE))
    blocks = pieces.where("kind = 1").groupBy("chunk", F.col("start").alias("level")).agg(F.min("priority").alias("priority"))
    cover = np.full(len(edges) - 1, np.iinfo(np.int64).max)
    for r in blocks.collect():  # at most two per chunk
        part = slice(r["chunk"] << r["level"], (r["chunk"] + 1) << r["level"])
        cover[part] = np.minimum(cover[part], r["priority"])
    whole = np.flatnonzero(cover != np.iinfo(np.int64).max)
    covered = [(0, int(c), int(edges[c]), int(edges[c + 1]) - 1, int(cover[c])) for c in whole]
    schema = pa.schema([(c, pa.int64()) for c in ("chunk", "start", "end", "priority")])

    def sweep(key, table):
        low, high, best = paint(*(table.column(c).to_numpy() for c in ("start", "end", "priority")))
        return pa.table([pa.array(np.full(len(low), key[0].as_py())), *map(pa.array, (low, high, best))], schema=schema)

    parts = pieces.where("kind = 0").union(spark.createDataFrame(covered, PIECE)).repartition(shuffle_partitions(spark), "chunk")
    return parts.groupBy("chunk").applyInArrow(sweep, "chunk bigint, start bigint, end bigint, priority bigint")


def _with_chunks(cuts: np.ndarray, ip: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chunk = np.searchsorted(cuts, batch.column(ip).to_numpy(), "right").astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(chunk)], names=[*batch.schema.names, "chunk"])

    return run


def locate_by_sweep(addresses: DataFrame, ranges: DataFrame, ip: str = "ip_num", keep: tuple[str, ...] = ()) -> DataFrame:
    """The rows of ``ranges.locate``: the location of every distinct address that lies in a range.

    Addresses that are null or no 32-bit numbers lie in none.
    """
    numbered = materialise(numbered_ranges(ranges))
    known = addresses.select(F.col(ip).cast("bigint").alias(ip), *keep).where(F.col(ip).between(0, (1 << ADDRESS_BITS) - 1))
    cuts = _cuts(numbered, known, ip)
    placed = known.mapInArrow(_with_chunks(cuts, ip), f"{_ddl(known)}, chunk bigint")
    segs = segments(numbered, cuts).select("chunk", F.col("start").alias(ip), F.struct("end", "priority").alias("_seg"))
    both = placed.withColumn("_asked", F.lit(True)).unionByName(segs, allowMissingColumns=True)
    upto = Window.partitionBy("chunk").orderBy(ip, F.col("_asked").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    filled = both.withColumn("_last", F.last("_seg", ignorenulls=True).over(upto)).where(F.col("_asked") & (F.col(ip) <= F.col("_last.end")))
    found = filled.select(ip, *keep, F.col("_last.priority").alias("priority"))
    return lookup_join(found, numbered.select("priority", "location"), ["priority"], [ip]).select(ip, *keep, "location")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
