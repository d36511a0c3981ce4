"""Exact deduplication by a tree-merge of sorted digest runs.

Every document becomes a small digest row; texts are never shuffled. A task sorts the digests of a
batch of its documents and joins equal ones, so that a text that fills a third of the corpus
leaves the scan as one row per batch. These sorted pieces make up the first runs, by task. In each
round ``fan_in`` neighbouring runs are exchanged: they come together sorted by digest, and one pass
over the sorted rows, which carries the group that is open from one Arrow batch to the next, merges
them into a sorted run with a row per digest, its smallest and largest id and its size. Within a round the
digests spread over all partitions, so no task holds a whole run and the last round is no funnel.
Two texts are taken as equal only if SHA-256, length and a second, independent hash agree, which is
tested anew at every level.

The way back follows the same tree: a merged row hands its result to the rows of the runs that it
came from, and a first row to the documents whose ids it has kept. No step joins all members of a
group to one key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sorrel.llm.common import shuffle_partitions, stored

RUNS = 64
FAN_IN = 8
#: A group is told apart by all three, so equal SHA-256 values alone do not join two texts.
DIGEST = ["_sha", "_bytes", "_check"]
#: A row of a run: ``_known`` of its ``_n`` documents have an id, and only then are its ids of use.
RUN = "_run int, _sha binary, _bytes int, _check long, _low long, _high long, _known long, _n long"
MOST = np.iinfo(np.int64).max


def digests(docs: DataFrame, text: Column, runs: int = RUNS) -> DataFrame:
    """The id, run and digest of every row; a null text counts as empty."""
    whole = F.coalesce(text, F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.pmod(F.spark_partition_id(), F.lit(runs)).cast("int").alias("_run"),
        F.unhex(F.sha2(whole, 256)).alias("_sha"), F.octet_length(whole).alias("_bytes"),
        F.xxhash64(whole).alias("_check"),
    )


def _new_groups(rows: pa.Table) -> np.ndarray:
    """Where, in sorted rows, another run or digest begins."""
    sha = np.frombuffer(b"".join(rows.column("_sha").to_pylist()), np.uint8).reshape(rows.num_rows, -1)
    fresh = np.ones(rows.num_rows, bool)
    fresh[1:] = (sha[1:] != sha[:-1]).any(axis=1)
    for name in ("_run", "_bytes", "_check"):
        column = rows.column(name).to_numpy()
        fresh[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(fresh)


def _first_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each batch sorted by digest, equal ones joined, with the ids that they stand for."""
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch]).sort_by([(c, "ascending") for c in ("_run", *DIGEST)])
        starts = _new_groups(rows)
        ids = rows.column("doc_id").combine_chunks()
        ids = ids.chunk(0) if isinstance(ids, pa.ChunkedArray) else ids
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        values = ids.fill_null(0).to_numpy(zero_copy_only=False)
        low, high = np.where(known, values, MOST), np.where(known, values, -MOST - 1)
        counts = np.diff(np.append(starts, rows.num_rows))
        offsets = pa.array(np.append(starts, rows.num_rows).astype(np.int32))
        heads = rows.take(pa.array(starts)).select(["_run", *DIGEST]).combine_chunks().to_batches()[0]
        yield pa.RecordBatch.from_arrays(
            [*heads.columns, *map(pa.array, (
                np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts), np.add.reduceat(known.astype(np.int64), starts), counts,
            )), pa.ListArray.from_arrays(offsets, ids)],
            names=["_run", *DIGEST, "_low", "_high", "_known", "_n", "_ids"],
        )


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One sorted run out of sorted rows: rows of one digest become one, across batches too."""
    names = ["_run", *DIGEST, "_low", "_high", "_known", "_n"]
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        starts = _new_groups(rows)
        low, high, known, n = (rows.column(c).to_numpy() for c in ("_low", "_high", "_known", "_n"))
        sums = [np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts), np.add.reduceat(known, starts), np.add.reduceat(n, starts)]
        heads = rows.take(pa.array(starts)).select(["_run", *DIGEST])
        done = pa.Table.from_arrays([*heads.columns, *map(pa.array, sums)], schema=batch.schema)
        # The last digest may go on in the next batch.
        held = done.slice(done.num_rows - 1).combine_chunks()
        yield from done.slice(0, done.num_rows - 1).select(names).to_batches()
    if held is not None:
        yield from held.select(names).to_batches()


def merge_runs(rows: DataFrame, run: Column) -> DataFrame:
    """One round: runs with the same new run number become one sorted run with a row per digest."""
    n = shuffle_partitions(rows.sparkSession)
    dealt = rows.withColumn("_run", run).select("_run", *DIGEST, "_low", "_high", "_known", "_n")
    return dealt.repartition(n, "_run", *DIGEST).sortWithinPartitions("_run", *DIGEST).mapInArrow(_merged, RUN)


def groups_of_equal_text(
    docs: DataFrame, text: Column | None = None, keep: str = "largest", runs: int = RUNS, fan_in: int = FAN_IN
) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)`` for every row of ``docs``.

    ``keep`` names the id of a group that stays. Rows that repeat a whole document, id
    included, count in ``group_size`` and share ``kept``. A null id is kept only if the
    group has no other. A very long text is hashed whole. Further columns do not matter; an
    empty table gives an empty result.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError("keep must be largest or smallest")
    # Stored as read, so that every later step sees the same runs.
    first = stored(digests(docs, F.col("text") if text is None else text, runs).mapInArrow(_first_pieces, f"{RUN}, _ids array<long>"))
    levels = [stored(merge_runs(first, F.col("_run")))]
    left = runs
    while left > 1:
        left = -(-left // fan_in)
        levels.append(stored(merge_runs(levels[-1], F.floor(F.col("_run") / fan_in).cast("int"))))
    top = levels.pop()
    while levels:
        below = levels.pop().select(F.col("_run").alias("_from"), *DIGEST)
        below = below.withColumn("_run", F.floor(F.col("_from") / fan_in).cast("int"))
        top = below.join(top, ["_run", *DIGEST]).drop("_run").withColumnRenamed("_from", "_run")
    keep_id = F.when(F.col("_known") > 0, F.col("_high" if keep == "largest" else "_low"))
    met = first.select("_run", *DIGEST, "_ids").join(top.select("_run", *DIGEST, keep_id.alias("keep_id"), "_n"), ["_run", *DIGEST])
    return met.select(F.explode("_ids").alias("doc_id"), "keep_id", "_n", "_sha").select(
        "doc_id", "keep_id", F.col("_n").alias("group_size"), F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"),
    )


def drop_equal_texts(docs: DataFrame, keep: str = "largest") -> DataFrame:
    """The rows of ``docs`` that stay, columns unchanged.

    Of rows with equal id and text one stays; of rows without an id and equal text too.
    """
    id_key = lambda c: F.coalesce(c, F.lit(-(2**63)))
    kept = groups_of_equal_text(docs, keep=keep).where("kept").select(
        id_key(F.col("doc_id")).alias("_id"), F.unhex("text_sha256").alias("_sha")
    )
    sha = F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")), 256))
    whole = docs.select(F.struct("*").alias("_doc"), id_key(F.col("doc_id")).alias("_id"), sha.alias("_sha"))
    return whole.join(kept, ["_id", "_sha"], "left_semi").dropDuplicates(["_id", "_sha"]).select("_doc.*")
