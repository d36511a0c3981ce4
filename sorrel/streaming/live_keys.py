"""Expiring keys as the state of a stream.

The changes of the serving table (puts with or without expiry, and deletes) come in as a stream, and what
lives under a key is the key's state in the stream itself. So a batch touches only the keys that it names and
those whose time has come; no log is listed or folded anew. Time is the event time ``written_at``, so that a
run over old changes expires what it should, whenever it runs:

* the newest write of a key, by ``(written_at, seq)``, replaces all its pages; equal writes add their pages;
* a timer at ``expires_at`` takes the key away and says so;
* a delete leaves a stone until the watermark has passed it, as only then can no older write follow.

State rows are so bounded by the keys that live and the deletes of the last moments. The state is
checkpointed with the stream's offsets: a restarted or repeated batch starts from the state before it.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PUT, DELETE, EXPIRE = "put", "delete", "expire"
EVENTS = "namespace string, key string, page bigint, value string, event string, at bigint, seq bigint"
#: Far enough for a key that never expires.
NEVER = 2**62


class LiveKeys(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", "written bigint, seq bigint, expires bigint, deleted boolean")
        self.pages = handle.getMapState("pages", "page bigint", "value string")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        writes: dict[tuple, list[Row]] = {}
        for r in rows:
            writes.setdefault((r["written"], r["seq"]), []).append(r)
        state = self.newest.get()
        # The state can only give way to a newer write; an equal one brings further pages of it.
        version = max(writes)
        held = (state[0], state[1]) if state is not None else None
        if held is not None and version < held:
            return
        parts = writes[version]
        if held != version:
            self._clear()
            gone = parts[0]["deleted"]
            expires = NEVER if parts[0]["expires"] is None else parts[0]["expires"]
            now = timerValues.getCurrentWatermarkInMs()
            if not gone and expires <= now:
                # It has expired before it came.
                if held is not None and not state[3]:
                    yield self._event(key, EXPIRE, expires, version[1])
                return
            self.newest.update((*version, expires, gone))
            # Of a delete nothing is left once no older write can come.
            until = version[0] + 1 if gone else expires
            if until < NEVER:
                self.handle.registerTimer(until)
            if gone:
                if held is not None and not state[3]:
                    yield self._event(key, DELETE, *version)
                return
        elif state[3]:
            return
        for r in parts:
            if not self.pages.containsKey((r["page"],)):
                self.pages.updateValue((r["page"],), (r["value"],))
                yield Row(namespace=key[0], key=key[1], page=r["page"], value=r["value"], event=PUT, at=version[0], seq=version[1])

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        state = self.newest.get()
        if state is None:
            return
        _, seq, expires, gone = state
        if gone:
            self.newest.clear()
        elif expires <= expiredTimerInfo.getExpiryTimeInMs():
            self._clear()
            yield self._event(key, EXPIRE, expires, seq)

    def _clear(self) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if self.pages.exists():
            self.pages.clear()
        self.newest.clear()

    @staticmethod
    def _event(key: tuple, event: str, at: int, seq: int) -> Row:
        return Row(namespace=key[0], key=key[1], page=None, value=None, event=event, at=at, seq=seq)

    def close(self) -> None:
        pass


def use_keyed_state(spark: SparkSession) -> None:
    """Keyed state with timers needs the state store on disk."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def key_events(changes: DataFrame, delay: str = "0 seconds") -> DataFrame:
    """What becomes of keys, from a stream of serving-table changes.

    ``put`` rows carry a page that now lives, ``delete`` and ``expire`` rows a key that is gone. ``at`` is the
    time of the write or the expiry in milliseconds. Changes without a key or a time are left out, and so is
    what comes later than ``delay`` behind the newest change.
    """
    millis = lambda c: F.unix_millis(F.col(c)).alias(c.split("_")[0])
    known = changes.where("namespace is not null and key is not null and written_at is not null")
    timed = known.withWatermark("written_at", delay).select(
        "namespace", "key", F.coalesce("page", F.lit(0)).cast("bigint").alias("page"), "value",
        F.unix_millis("expires_at").alias("expires"), F.coalesce("deleted", F.lit(False)).alias("deleted"),
        "written_at", millis("written_at"), F.coalesce("seq", F.lit(0)).cast("bigint").alias("seq"),
    )
    return timed.groupBy("namespace", "key").transformWithState(
        statefulProcessor=LiveKeys(), outputStructType=EVENTS, outputMode="Append", timeMode="EventTime"
    )


def start_events(changes: DataFrame, path: str, checkpoint: str, delay: str = "0 seconds", drain: bool = False) -> StreamingQuery:
    """Appends the events of the keys to files, each once however often a batch runs."""
    use_keyed_state(changes.sparkSession)
    trigger = {"availableNow": True} if drain else {"processingTime": "5 seconds"}
    return (
        key_events(changes, delay).writeStream.format("parquet").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )
