"""Locate IPv4 numbers in possibly overlapping ranges; the narrowest range wins.

A range splits into at most 62 aligned blocks of 2^level addresses. A block is
identified by ``(level, prefix)``, one best range is kept for each, and an address
finds its range by plain equality on its own prefixes. Blocks wider than 2^16 are
repeated for the 2^16 blocks inside them (at most 65536 per level), so no join key
covers more than 65536 addresses.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sorrel.operators.joins import lookup_join
from sorrel.session import materialise

TOP_LEVEL = 16
ADDRESS_BITS = 32


def _aligned_blocks(start: Column, end: Column) -> Column:
    def at_level(level: Column) -> Column:
        size = F.pow(F.lit(2), level).cast("bigint")
        low = F.ceil(start / size).cast("bigint")
        high = F.floor((end + 1) / size).cast("bigint") - 1
        left = F.when((low <= high) & (low % 2 == 1), F.struct(level.alias("level"), low.alias("prefix")))
        right = F.when((low <= high) & (high % 2 == 0), F.struct(level.alias("level"), high.alias("prefix")))
        return F.array(left, right)

    levels = F.sequence(F.lit(0), F.lit(ADDRESS_BITS))
    return F.filter(F.flatten(F.transform(levels, at_level)), lambda b: b.isNotNull())


def range_fault(start: Column, end: Column) -> Column:
    """Why a range covers no address: ``start``, ``end``, ``reversed`` or ``outside``; null if it does."""
    return (
        F.when(start.isNull(), "start").when(end.isNull(), "end").when(start > end, "reversed")
        .when((start < 0) | (end >= 1 << ADDRESS_BITS), "outside")
    )


def rejected_ranges(ranges: DataFrame) -> DataFrame:
    """The ranges that the location leaves out, with the reason."""
    return ranges.withColumn("reject_reason", range_fault(F.col("start"), F.col("end"))).where("reject_reason is not null")


def numbered_ranges(ranges: DataFrame) -> DataFrame:
    """Unique valid ranges with their ``priority``: narrower first, then lower start.

    Width and start have 32 bits each and share one signed 64-bit number, so the best
    of several ranges is a plain minimum. Of equal ranges the lowest label stays.
    """
    valid = ranges.where(range_fault(F.col("start"), F.col("end")).isNull()).select(
        F.col("start").cast("bigint"), F.col("end").cast("bigint"), "location"
    )
    width = F.col("end") - F.col("start")
    return (
        valid.groupBy("start", "end")
        .agg(F.min("location").alias("location"))
        .withColumn("priority", (width - (1 << 31)) * (1 << 32) + F.col("start"))
    )


def range_blocks(numbered: DataFrame) -> DataFrame:
    """Unique ``(level, prefix)`` blocks with the best priority that covers each."""

    def unique(df: DataFrame) -> DataFrame:
        return df.groupBy("level", "prefix").agg(F.min("priority").alias("priority"))

    split = numbered.select("priority", F.explode(_aligned_blocks(F.col("start"), F.col("end"))).alias("_b"))
    wide = F.col("level") > TOP_LEVEL
    factor = F.pow(F.lit(2), F.greatest(F.col("level") - TOP_LEVEL, F.lit(0))).cast("bigint")
    inside = F.sequence(F.col("prefix") * factor, (F.col("prefix") + 1) * factor - 1)
    narrowed = unique(split.select("priority", "_b.*")).select(
        F.least("level", F.lit(TOP_LEVEL)).alias("level"),
        F.explode(F.when(wide, inside).otherwise(F.array("prefix"))).alias("prefix"),
        "priority",
    )
    return unique(narrowed)


def locate(addresses: DataFrame, ranges: DataFrame, ip: str = "ip_num", keep: tuple[str, ...] = ()) -> DataFrame:
    """Location of every distinct address that lies in a range; one row per address.

    ``addresses`` must already be distinct on ``ip``; columns in ``keep`` are carried along.
    """
    numbered = materialise(numbered_ranges(ranges))
    blocks = materialise(range_blocks(numbered))
    # An address is looked up only at levels that occur, and no key is hot, so no salt is needed.
    levels = [r["level"] for r in blocks.select("level").distinct().collect()]  # 17 at most
    probes = addresses.select(ip, *keep, F.explode(F.array(*map(F.lit, sorted(levels))).cast("array<int>")).alias("level"))
    probes = probes.withColumn("prefix", F.expr(f"shiftright({ip}, level)"))
    best = (
        lookup_join(probes, blocks, ["level", "prefix"], [ip], salts=0)
        .groupBy(ip)
        .agg(F.min("priority").alias("priority"), *[F.max(c).alias(c) for c in keep])
    )
    return lookup_join(best, numbered.select("priority", "location"), ["priority"], [ip]).select(ip, *keep, "location")


def ip_location(log: DataFrame, ranges: DataFrame, ip: str, salt_on: list[str], locate: Callable = locate) -> DataFrame:
    """Every log row with its location, null when no range holds the address.

    Addresses are located once each; the log meets the result in a join salted by
    ``salt_on``, which must vary within an address. ``locate`` may be ``sweep.locate_by_sweep``.
    """
    located = materialise(locate(log.select(ip).distinct(), ranges, ip))
    return lookup_join(log, located, [ip], salt_on, "left")


def location_counts(
    log: DataFrame, ranges: DataFrame, ip: str, unmatched: bool = False, locate: Callable = locate
) -> DataFrame:
    """Rows per location; addresses are counted first, so a busy address is one row afterwards.

    With ``unmatched``, rows outside all ranges or without a valid address count under a
    null location.
    """
    counted = log.groupBy(ip).agg(F.count(F.lit(1)).alias("_n"))
    located = locate(counted, ranges, ip, keep=("_n",))
    if unmatched:
        located = counted.join(located.drop("_n"), ip, "left")
    return located.groupBy("location").agg(F.sum("_n").alias("ip_count"))
