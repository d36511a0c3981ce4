"""Conflict-constrained best-fit packing of documents into bins of a fixed number of words.

Documents are dealt by a hash of their id into shards of bounded size, and every shard packs
its own bins, largest pieces first. A bin never holds two pieces of one source, nor two of
one cluster of duplicates, unless ``source_conflicts`` switches the first rule off. Bins are
kept in order of what is left in them; from the smallest residual that fits, the search goes
on to the successor until a bin shares no bit with the piece, so the tightest compatible bin
is found. A document longer than a bin is cut into full bins and a last piece. Splitting
into shards costs at most a few open bins per shard.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sorrel.llm.common import n_words, shuffle_partitions, stored

CAPACITY = 2048
SHARD_ROWS = 4_000
OUT = "doc_id long, source string, piece int, start long, n_words long, bin_id long, bin_start int"


class Bins:
    """The open bins of a shard, ordered by residual and grouped by their bitmaps."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.residuals: list[int] = []
        self.groups: dict[int, dict[tuple[int, int], list[int]]] = {}
        self.opened = 0

    def open(self) -> int:
        self.opened += 1
        return self.opened - 1

    def put(self, room: int, bits: tuple[int, int], bin_no: int) -> None:
        if room <= 0:
            return
        group = self.groups.get(room)
        if group is None:
            group = self.groups[room] = {}
            insort(self.residuals, room)
        group.setdefault(bits, []).append(bin_no)

    def take(self, need: int, source: int, cluster: int) -> tuple[int, tuple[int, int], int]:
        """The tightest compatible bin, taken out, or a new one: room, bitmaps, number."""
        for at in range(bisect_left(self.residuals, need), len(self.residuals)):
            room = self.residuals[at]
            group = self.groups[room]
            for bits, bins in group.items():
                if not (bits[0] & source or bits[1] & cluster):
                    bin_no = bins.pop()
                    if not bins:
                        del group[bits]
                    if not group:
                        del self.groups[room]
                        del self.residuals[at]
                    return room, bits, bin_no
        return self.capacity, (0, 0), self.open()


def bits_of(values: pd.Series, shared_only: bool) -> list[int]:
    """One bit per value; none for values that occur once, where asked."""
    codes, _ = pd.factorize(values, use_na_sentinel=False)
    counts = np.bincount(codes) if len(codes) else codes
    places: dict[int, int] = {}
    return [
        0 if shared_only and counts[c] == 1 else 1 << places.setdefault(c, len(places)) for c in codes
    ]


def pack_shard(shard: pd.DataFrame, capacity: int, source_conflicts: bool) -> pd.DataFrame:
    """Best fit, largest piece first, for the documents of one shard with words."""
    shard = shard.sort_values(["_words", "doc_id", "_cluster"], ascending=[False, True, True], kind="stable")
    clusters = bits_of(shard["_cluster"], True)
    sources = bits_of(shard["source"], False) if source_conflicts else [0] * len(shard)
    bins, first, out = Bins(capacity), int(shard["_shard"].iloc[0]) << 32, []
    tails = []
    for doc_id, source, words, source_bit, cluster_bit in zip(
        shard["doc_id"], shard["source"], shard["_words"], sources, clusters
    ):
        full, tail = divmod(int(words), capacity)
        for piece in range(full):
            out.append((doc_id, source, piece, piece * capacity, capacity, first + bins.open(), 0))
        if tail:
            tails.append((tail, doc_id, source, full, source_bit, cluster_bit))
    tails.sort(key=lambda t: -t[0])
    for tail, doc_id, source, full, source_bit, cluster_bit in tails:
        room, bits, bin_no = bins.take(tail, source_bit, cluster_bit)
        bins.put(room - tail, (bits[0] | source_bit, bits[1] | cluster_bit), bin_no)
        out.append((doc_id, source, full, full * capacity, tail, first + bin_no, capacity - room))
    frame = pd.DataFrame(out, columns=[c.split()[0] for c in OUT.split(", ")])
    return frame.astype({"doc_id": "Int64"})


def pack(
    docs: DataFrame, capacity: int = CAPACITY, cluster: Column | None = None, source_conflicts: bool = True,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """One row per piece: document, word span, bin, and the place in the bin.

    ``cluster`` names a document's cluster of duplicates, by default its text. A null source
    counts as a source of its own. Documents without words take no room and come out once
    with a null ``bin_id``. Repeated rows are packed as often as they occur, never together.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")
    text = F.coalesce(F.col("text"), F.lit(""))
    cluster = F.xxhash64(text) if cluster is None else F.xxhash64(cluster)
    rows = stored(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        n_words(F.col("text")).alias("_words"), cluster.alias("_cluster"),
        F.monotonically_increasing_id().alias("_row"),
    ))
    shards = max(1, -(-rows.count() // shard_rows))
    # Row numbers are fixed by the stored table; with them one document repeated often still spreads.
    dealt = rows.where("_words > 0").withColumn(
        "_shard", F.pmod(F.xxhash64("doc_id", "_row"), F.lit(shards)).cast("int")
    )
    packed = dealt.repartition(shuffle_partitions(docs.sparkSession), "_shard").groupBy("_shard").applyInPandas(
        lambda frame: pack_shard(frame, capacity, source_conflicts), OUT
    )
    empty = rows.where("_words = 0").select(
        "doc_id", "source", F.lit(0).alias("piece"), F.lit(0).cast("long").alias("start"), F.col("_words").alias("n_words"),
        F.lit(None).cast("long").alias("bin_id"), F.lit(0).alias("bin_start"),
    )
    return packed.union(empty)
