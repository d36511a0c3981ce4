"""Streaming sources and where they start."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sorrel.schemas import CHANGE_EVENT, STREAM_PARTITIONS, STREAM_RATE_PER_PARTITION, STREAM_SECONDS_DIRECT

#: Offsets per trigger of the direct stream: messages per second and partition, partitions, seconds.
DIRECT_OFFSETS = STREAM_RATE_PER_PARTITION * STREAM_PARTITIONS * STREAM_SECONDS_DIRECT


def kafka_options(
    servers: str,
    topics: list[str],
    reset: str = "largest",
    starting_offsets: str | None = None,
    max_offsets: int | None = None,
    fail_on_data_loss: bool = True,
    consumer_threads: int | None = None,
) -> dict[str, str]:
    """Options for the Kafka reader.

    ``smallest`` starts a new query at the earliest offsets and anything else at the
    latest. A trigger takes all there is unless ``max_offsets`` limits it, for instance
    to :data:`DIRECT_OFFSETS`. Lost offsets end the query unless the caller accepts them.
    """
    earliest = reset.lower() in ("smallest", "earliest")
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting_offsets or ("earliest" if earliest else "latest"),
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    if consumer_threads:
        options["minPartitions"] = str(consumer_threads)
    return options


def behaviour_stream(
    spark: SparkSession, kind: str, path: str | None = None, options: dict[str, str] | None = None
) -> DataFrame:
    """Messages as a ``value`` text column, from Kafka or from arriving text files."""
    if kind == "kafka":
        stream = spark.readStream.format("kafka").options(**(options or {})).load()
        return stream.select(F.col("value").cast("string").alias("value"))
    if kind == "files":
        return spark.readStream.options(**(options or {})).text(path)
    raise ValueError(f"unknown kind of stream: {kind}")


def change_stream(
    spark: SparkSession, kind: str, path: str | None = None, options: dict[str, str] | None = None
) -> DataFrame:
    """Item change events as ``(type, sid, sequence)``; ``sequence`` orders them as they arrived."""
    if kind == "kafka":
        raw = spark.readStream.format("kafka").options(**(options or {})).load()
        arrival = F.struct("timestamp", "partition", "offset")
        text = raw.select(F.col("value").cast("string").alias("value"), arrival.alias("sequence"))
    elif kind == "files":
        raw = spark.readStream.options(**(options or {})).text(path)
        meta = [F.col(f"_metadata.{c}").alias(c) for c in ("file_modification_time", "file_path", "file_block_start")]
        text = raw.select("value", F.struct(*meta).alias("sequence"))
    else:
        raise ValueError(f"unknown kind of stream: {kind}")
    return parse_changes(text.where(F.trim("value") != ""))


def parse_changes(messages: DataFrame, value: str = "value") -> DataFrame:
    others = [c for c in messages.columns if c != value]
    parsed = messages.select(*others, F.from_json(F.col(value), CHANGE_EVENT).alias("_event"))
    return parsed.select(*others, "_event.type", "_event.sid")
