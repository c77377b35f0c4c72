"""Scalar building blocks, as Column functions: lenient parsing, boundary differences, rounding, great circles."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The sphere's radius in metres, and knots in a metre per second.
EARTH_M, KNOTS = 6_371_000, 1.943844


def safe_double(text: Column) -> Column:
    """A number's text as a double, else null: plain decimal notation only, with or without an exponent."""
    plain = F.trim(text).rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$")
    return F.when(plain, text.try_cast("double"))


def parse_time(text: Column) -> Column:
    """The first 19 characters of an ISO time; one-digit fields are let through, impossible dates give null."""
    return F.try_to_timestamp(F.left(text, F.lit(19)), F.lit("yyyy-M-d'T'H:m:s"))


def parse_stamp(name: Column) -> Column:
    """The 14-digit stamp that a file's name begins with."""
    stamp = F.left(name, F.lit(14))
    return F.when(stamp.rlike("^[0-9]{14}$"), F.try_to_timestamp(stamp, F.lit("yyyyMMddHHmmss")))


def month_of(text: Column) -> Column:
    """The collection month of an ISO time's text, or `invalid`."""
    return F.when(text.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}"), F.left(text, F.lit(7))).otherwise(F.lit("invalid"))


def boundaries(unit: str, start: Column, end: Column) -> Column:
    """How many boundaries of a unit (minute, second) lie between two times."""
    size = {"second": 1, "minute": 60}[unit]
    at = lambda t: F.unix_seconds(F.date_trunc(unit, t))
    return ((at(end) - at(start)) / size).cast("long")


def round_at(value: Column, digits: int) -> Column:
    """Rounding by scaling, half away from zero, on the double itself."""
    scale = F.lit(float(10**digits))
    return F.round(value * scale) / scale


def share_of_duplicates(unique: Column, rows: Column) -> Column:
    return round_at(1 - F.try_divide(unique.cast("double"), rows.cast("double")), 4)


def knots(lat0: Column, lon0: Column, lat1: Column, lon1: Column, seconds: Column) -> Column:
    """Speed of a great-circle move."""
    half = lambda a, b: F.pow(F.sin(F.radians(a - b) / 2), F.lit(2.0))
    chord = half(lat1, lat0) + F.cos(F.radians(lat0)) * F.cos(F.radians(lat1)) * half(lon1, lon0)
    return F.lit(2.0 * EARTH_M) * F.asin(F.sqrt(chord)) / seconds * F.lit(KNOTS)


def slug_column(name: Column) -> Column:
    made = F.regexp_replace(F.regexp_replace(F.lower(name), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.when(made == "", F.lit("unknown")).otherwise(made)


def slug(name: str) -> str:
    return re.sub("[^a-z0-9]+", "-", name.lower()).strip("-") or "unknown"


def day_text(t: Column) -> Column:
    return F.date_format(t, "yyyy-MM-dd")
