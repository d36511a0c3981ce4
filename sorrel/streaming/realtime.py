"""Near-real-time recommendations from a stream of behaviour messages."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sorrel.functions.lists import decode_scored
from sorrel.operators.behaviour import accepted, parse_messages, rejected, score
from sorrel.operators.realtime import content_recommendations, prepared_recommendations
from sorrel.operators.serving import latest, lookup, paged_ids, with_ttl
from sorrel.schemas import OFFLINE_ALS, OFFLINE_CB, ONLINE_ALS, ONLINE_CB, STREAM_SECONDS_DIRECT, STREAM_WEIGHTS
from sorrel.sinks.serving import append_batch, changes_of, read_changes


def recommend(
    scores: DataFrame, log: DataFrame, batch_id: int, default_list: str | None = None, limit: int | None = None
) -> DataFrame:
    """Changes to the serving table for one batch of scores.

    ``log`` is the change log of the prepared lists; only the keys of the batch are
    looked up in it. Scores of earlier batches are not added in: a batch stands for
    itself.
    """
    now = F.current_timestamp()

    def stored(namespace: str, key: str) -> DataFrame:
        keys = scores.select(F.col(key).cast("string").alias("key"))
        return lookup(latest(changes_of(log, namespace, keys)), namespace, now)

    similar = stored(OFFLINE_CB, "item_id").select(
        F.col("key").cast("bigint").alias("base"), decode_scored(F.col("value")).alias("entries")
    )
    ranked = content_recommendations(scores, similar, limit)
    content = paged_ids(ranked.withColumn("key", F.col("user_id").cast("string")), "key", "item", "rank")
    prepared = prepared_recommendations(scores, stored(OFFLINE_ALS, "user_id"), default_list)
    stamp, seq = F.current_timestamp(), F.lit(batch_id)

    def change(df: DataFrame, namespace: str) -> DataFrame:
        return with_ttl(df, namespace, F.col("key"), F.col("value"), stamp, seq, F.col("page"))

    return change(content, ONLINE_CB).unionByName(change(prepared, ONLINE_ALS))


def batch_writer(
    lists_path: str,
    online_path: str,
    rejects_path: str | None = None,
    weights: Mapping[str, float] = STREAM_WEIGHTS,
    default_list: str | None = None,
    limit: int | None = None,
) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function. A repeated batch replaces what it wrote before."""

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        spark = batch.sparkSession
        parsed = parse_messages(batch).persist()
        scores = score(accepted(parsed), weights).persist()
        try:
            log = read_changes(spark, lists_path)
            append_batch(recommend(scores, log, batch_id, default_list, limit), online_path, batch_id)
            if rejects_path:
                rows = rejected(parsed).withColumn("batch_id", F.lit(batch_id))
                (
                    rows.write.mode("overwrite")
                    .option("partitionOverwriteMode", "dynamic")
                    .partitionBy("batch_id")
                    .parquet(rejects_path)
                )
        finally:
            scores.unpersist()
            parsed.unpersist()

    return write


def start(
    stream: DataFrame,
    writer: Callable[[DataFrame, int], None],
    checkpoint: str,
    seconds: int = STREAM_SECONDS_DIRECT,
    drain: bool = False,
) -> StreamingQuery:
    """Runs every ``seconds``, or with ``drain`` until the input present now is used up."""
    trigger = {"availableNow": True} if drain else {"processingTime": f"{seconds} seconds"}
    return (
        stream.writeStream.foreachBatch(writer).option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )
