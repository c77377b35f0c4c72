"""Additive roll-ups of keyed and classified readings.

Readings have: file, unique_id, provider, time, key, coll_month, ingested, and lon_d/lat_d (typed positions).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.functions import grid
from fathomline.functions.identity import fingerprint
from fathomline.operators.classify import summed, tallies

DAILY, CELL, VESSEL = 5, 9, 8
INVALID = "invalid"


def at(res: int) -> Column:
    return grid.cell(F.col("lat_d"), F.col("lon_d"), res)


def collection_day() -> Column:
    return F.when(F.col("coll_month") != INVALID, F.left("time", F.lit(10)))


def group_meta(df: DataFrame) -> DataFrame:
    """One row for each (file, unique_id): extent in time and space, size, fingerprint."""
    ends = {"t": "time", "lon": "lon_d", "lat": "lat_d"}
    spans = [f(F.col(c)).alias(f"{n}_{e}") for n, c in ends.items() for e, f in (("min", F.min), ("max", F.max))]
    return df.groupBy("file", "unique_id").agg(
        F.min("provider").alias("provider"), F.count("*").alias("n_rows"), *spans, fingerprint(F.col("key")).alias("fingerprint"), F.min("ingested").alias("ingested")
    )


def file_counts(classified: DataFrame) -> DataFrame:
    return classified.groupBy("file", "unique_id").agg(*tallies())


def file_month_counts(classified: DataFrame) -> DataFrame:
    return classified.groupBy("file", "unique_id", "coll_month").agg(*tallies())


def daily(classified: DataFrame) -> DataFrame:
    """By provider, collection day and coarse cell; platforms are counted exactly, from one row for each first."""
    keys = ["provider", "coll_day", f"h3_r{DAILY}"]
    rows = classified.select("*", collection_day().alias("coll_day"), at(DAILY).alias(f"h3_r{DAILY}"))
    by_platform = rows.groupBy(*keys, "unique_id").agg(*tallies())
    return by_platform.groupBy(*keys).agg(*summed(), F.count("unique_id").alias("platforms"))


def month_cells(classified: DataFrame) -> DataFrame:
    return classified.groupBy("provider", "coll_month", at(CELL).alias(f"h3_r{CELL}")).agg(*tallies())


def vessel_days(classified: DataFrame) -> DataFrame:
    """By provider, platform, day and cell; rows without a valid day or position are left out."""
    rows = classified.where(F.col("coll_month") != INVALID).select("*", at(VESSEL).alias(f"h3_r{VESSEL}"))
    return rows.where(F.col(f"h3_r{VESSEL}").isNotNull()).groupBy("provider", F.col("unique_id").alias("platform"), F.left("time", F.lit(10)).alias("day"), f"h3_r{VESSEL}").agg(*tallies())


def recent_cells(classified: DataFrame) -> DataFrame:
    keys = ["file", "unique_id", "provider", "coll_month", "day", f"h3_r{CELL}"]
    return classified.select("*", collection_day().alias("day"), at(CELL).alias(f"h3_r{CELL}")).groupBy(*keys).agg(F.min("ingested").alias("ingested"), *tallies())


def finalize(meta: DataFrame, counts: DataFrame) -> DataFrame:
    """Group metadata with its counts summed over months, oldest first."""
    whole = counts.groupBy("file", "unique_id").agg(*summed()).drop("n_rows")
    return meta.join(whole, ["file", "unique_id"]).orderBy(F.asc_nulls_last("ingested"), "file")


def base_plus_delta(base: DataFrame, delta: DataFrame | None) -> DataFrame:
    """A base table and its signed deltas, as rows to be summed."""
    return base if delta is None else base.unionByName(delta.drop("run_id"), allowMissingColumns=True)


def live_cells(rows: DataFrame) -> DataFrame:
    kept = rows.where(F.col(f"h3_r{CELL}").isNotNull() & (F.col("coll_month") != INVALID))
    return kept.groupBy("provider", "coll_month", F.col(f"h3_r{CELL}").alias("h3")).agg(*summed()).where("n_rows > 0").select("provider", "coll_month", "h3", "n_rows", "n_unique")


def live_vessel_days(rows: DataFrame) -> DataFrame:
    """Keys with readings other than repeats under another id, so that a repeat adds no vessel."""
    kept = rows.groupBy("provider", "platform", "day", F.col(f"h3_r{VESSEL}").alias("h3")).agg(*summed())
    return kept.where("n_rows - n_dup_cross_id > 0").select("provider", "platform", "day", "h3", "n_rows", "n_unique")


def live_minutes(rows: DataFrame) -> DataFrame:
    names = ["min_underway", "min_slow", "min_stationary", "min_other"]
    kept = rows.groupBy("provider", "platform", "day", F.col(f"h3_r{VESSEL}").alias("h3")).agg(*(F.sum(n).cast("long").alias(n) for n in names))
    return kept.where(" OR ".join(f"{n} <> 0" for n in names))
