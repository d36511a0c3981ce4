"""IPv4 text and numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


_OCTET = "(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
_DOTTED = rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"


def ip_to_num(ip: Column) -> Column:
    """Dotted IPv4 text as a number; null unless it is four octets of 0-255."""
    text = F.trim(ip)
    parts = F.split(text, r"\.")
    octets = [F.get(parts, i).cast("bigint") for i in range(4)]
    number = octets[0] * 16777216 + octets[1] * 65536 + octets[2] * 256 + octets[3]
    return F.when(text.rlike(_DOTTED), number)


def num_to_ip(num: Column) -> Column:
    return F.concat_ws(".", *[F.shiftright(num, s).bitwiseAND(255).cast("string") for s in (24, 16, 8, 0)])
