"""Lookup joins that stay balanced when one key holds much of the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType

BROADCAST_BYTES = 16 << 20
SALTS = 32


def at_most(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has no more than ``rows`` rows; every task sends one number."""
    return df.count() <= rows


def _width(name: str, kind: object) -> Column:
    """Bytes of a value, about as much as it takes in memory."""
    column = F.col(f"`{name}`")
    if isinstance(kind, (StringType, BinaryType)):
        size = F.octet_length(column) + 16
    elif isinstance(kind, ArrayType) and not isinstance(kind.elementType, (StringType, BinaryType, ArrayType, MapType)):
        size = F.size(column) * 8 + 24
    elif isinstance(kind, (ArrayType, MapType)) or hasattr(kind, "fields"):
        size = F.octet_length(F.to_json(F.struct(column))) * 2 + 24
    else:
        size = F.lit(8)
    return F.coalesce(size, F.lit(8)).cast("bigint")


def measured_bytes(df: DataFrame) -> int:
    """Bytes of all rows, added up by one aggregation that combines in the tasks."""
    width = F.lit(16).cast("bigint")
    for field in df.schema:
        width = width + _width(field.name, field.dataType)
    return df.agg(F.sum(width)).head()[0] or 0


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    salt_on: Sequence[str],
    how: str = "inner",
    broadcast_bytes: int = BROADCAST_BYTES,
    salts: int = SALTS,
    known_bytes: int | None = None,
) -> DataFrame:
    """Join many ``rows`` to a narrow ``lookup``.

    The lookup is broadcast only when its measured (or ``known_bytes``) size is within
    ``broadcast_bytes``. Beyond that both sides are shuffled on the key and a salt: rows of
    one hot key spread over ``salts`` tasks by ``salt_on``, which must vary within a key,
    and every lookup row is repeated once per salt. Without ``salts`` the key alone is
    used, for keys that are known not to be hot.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be inner or left")
    size = measured_bytes(lookup) if known_bytes is None else known_bytes
    if size <= broadcast_bytes:
        return rows.join(F.broadcast(lookup), list(on), how)
    if not salts:
        return rows.join(lookup, list(on), how)
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*salt_on), F.lit(salts)).cast("int"))
    copies = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")
