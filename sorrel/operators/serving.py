"""Keyed serving table: upsert with optional expiry, delete, point-in-time view.

The table is a log of changes ``(namespace, key, page, value, expires_at, deleted,
written_at, seq)``. Long values are paged; one write gives all its pages the same
``(written_at, seq)`` and a key's state is the pages of its newest write.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sorrel.schemas import TTL_DAYS

KEY = ["namespace", "key", "page"]
COLUMNS = [*KEY, "value", "expires_at", "deleted", "written_at", "seq"]
PAGE_ITEMS = 1000


def puts(df: DataFrame, namespace: str | Column, key: Column, value: Column, written_at: Column,
         seq: Column, ttl_days: int | None = None, page: Column | None = None) -> DataFrame:
    """Changes that set ``value``; with ``ttl_days`` they expire that long after the write."""
    expires = written_at + F.expr(f"interval {ttl_days} days") if ttl_days else F.lit(None)
    return df.select(
        (F.lit(namespace) if isinstance(namespace, str) else namespace).alias("namespace"),
        key.cast("string").alias("key"),
        (F.lit(0) if page is None else page).cast("bigint").alias("page"),
        value.cast("string").alias("value"),
        expires.cast("timestamp").alias("expires_at"),
        F.lit(False).alias("deleted"),
        written_at.cast("timestamp").alias("written_at"),
        seq.cast("bigint").alias("seq"),
    )


def deletes(df: DataFrame, namespace: str | Column, key: Column, written_at: Column, seq: Column,
            page: Column | None = None) -> DataFrame:
    """Changes that remove a key."""
    gone = puts(df, namespace, key, F.lit(None), written_at, seq, page=page)
    return gone.withColumn("deleted", F.lit(True))


def latest(changes: DataFrame) -> DataFrame:
    """Newest write per key; combines before the shuffle, so a busy key costs one row per task."""
    version = F.struct("written_at", "seq")
    state = F.struct("value", "expires_at", "deleted", "written_at", "seq")
    pages = changes.groupBy(*KEY).agg(F.max_by(state, version).alias("_s")).select(*KEY, "_s.*")
    newest = F.max(version).over(Window.partitionBy("namespace", "key"))
    return pages.withColumn("_newest", newest).where(version == F.col("_newest")).drop("_newest")


def upsert(current: DataFrame, changes: DataFrame) -> DataFrame:
    return latest(current.select(*COLUMNS).unionByName(changes.select(*COLUMNS)))


def live(state: DataFrame, now: Column) -> DataFrame:
    """Keys that are neither deleted nor expired; a key expires at its instant, not after it."""
    return state.where(~F.col("deleted") & (F.col("expires_at").isNull() | (F.col("expires_at") > now)))


def delete(current: DataFrame, keys: DataFrame) -> DataFrame:
    """State without the given ``(namespace, key)`` pairs, all pages of them."""
    return current.join(keys.select("namespace", "key").distinct(), ["namespace", "key"], "left_anti")


def lookup(state: DataFrame, namespace: str, now: Column) -> DataFrame:
    """``(key, page, value)`` of a namespace, for joining in place of point reads."""
    return live(state.where(F.col("namespace") == namespace), now).select("key", "page", "value")


def paged_ids(ranked: DataFrame, key: str, item: str, rank: str, per_page: int = PAGE_ITEMS) -> DataFrame:
    """``(key, page, value)`` with at most ``per_page`` comma-joined ids per page, in rank order."""
    page = F.floor((F.col(rank) - 1) / per_page).cast("bigint")
    entries = F.sort_array(F.collect_list(F.struct(F.col(rank).alias("r"), F.col(item).alias("i"))))
    return ranked.groupBy(key, page.alias("page")).agg(
        F.array_join(F.transform(entries, lambda e: e["i"].cast("string")), ",").alias("value")
    )


def with_ttl(df: DataFrame, namespace: str, key: Column, value: Column, written_at: Column, seq: Column,
             page: Column | None = None) -> DataFrame:
    return puts(df, namespace, key, value, written_at, seq, TTL_DAYS, page)
