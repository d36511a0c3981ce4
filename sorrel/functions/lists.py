"""Text form of recommendation lists: ``id:sim,id:sim`` and ``id,id``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def encode_scored(entries: Column, digits: int | None = None) -> Column:
    """``array<struct<item,sim>>`` to ``id:sim,…``; ``digits`` fixes the decimals."""

    def one(e: Column) -> Column:
        sim = e["sim"].cast("string") if digits is None else F.format_string(f"%.{digits}f", e["sim"])
        return F.concat(e["item"].cast("string"), F.lit(":"), sim)

    return F.array_join(F.transform(entries, one), ",")


def decode_scored(text: Column) -> Column:
    """Inverse of :func:`encode_scored`; entries that do not parse are left to :func:`undecoded`."""
    pieces = F.filter(F.split(F.coalesce(text, F.lit("")), ","), lambda p: F.trim(p) != "")

    def one(p: Column) -> Column:
        pair = F.split(F.trim(p), ":")
        return F.struct(
            F.get(pair, 0).try_cast("bigint").alias("item"),
            F.get(pair, 1).try_cast("double").alias("sim"),
        )

    return F.filter(F.transform(pieces, one), lambda e: e["item"].isNotNull() & e["sim"].isNotNull())


def undecoded(text: Column) -> Column:
    """The entries of a scored list that :func:`decode_scored` cannot read."""
    pieces = F.filter(F.split(F.coalesce(text, F.lit("")), ","), lambda p: F.trim(p) != "")

    def broken(p: Column) -> Column:
        pair = F.split(F.trim(p), ":")
        return F.get(pair, 0).try_cast("bigint").isNull() | F.get(pair, 1).try_cast("double").isNull()

    return F.filter(pieces, broken)


def encode_ids(ids: Column) -> Column:
    return F.array_join(F.transform(ids, lambda i: i.cast("string")), ",")


def decode_ids(text: Column) -> Column:
    pieces = F.filter(F.split(F.coalesce(text, F.lit("")), ","), lambda p: F.trim(p) != "")
    return F.filter(F.transform(pieces, lambda p: F.trim(p).try_cast("bigint")), lambda i: i.isNotNull())
