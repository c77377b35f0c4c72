"""Identity of a reading: a hash of its own text, never of a re-formatted number."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

WRAP = 1 << 64


def joined(*fields: Column) -> Column:
    """Fields between bars; a missing field is an empty one, so that the others keep their places."""
    return F.concat_ws("|", *(F.coalesce(f.cast("string"), F.lit("")) for f in fields))


def key(*fields: Column) -> Column:
    return F.md5(joined(*fields))


def low64(hex_key: Column) -> Column:
    """The last eight bytes of the key, least significant first, as an exact decimal."""
    pairs = [F.substr(hex_key, F.lit(k), F.lit(2)) for k in range(31, 16, -2)]
    return F.conv(F.concat(*pairs), 16, 10).cast("decimal(20,0)")


def fingerprint(hex_key: Column) -> Column:
    """Order-free fingerprint of a set of readings: the sum of their low halves, modulo 2^64 (an aggregate)."""
    return (F.sum(low64(hex_key)) % F.lit(Decimal(WRAP))).cast("decimal(20,0)")
