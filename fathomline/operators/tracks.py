"""Track analytics: minute centroids, speed bands, time underway."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fathomline.functions import grid
from fathomline.functions.scalars import day_text, knots, parse_time

# Knots below which a minute is stationary or slow, and from which it is a glitch; seconds of a gap.
STATIONARY, SLOW, GLITCH, GAP_S = 0.5, 2.0, 60.0, 300
RES = 8


def keep_groups(index: DataFrame) -> DataFrame:
    """Groups whose minutes count: live, with a reading of their own."""
    return index.where("status = 'live' AND n_unique > 0").select("file", "unique_id")


def minutes(readings: DataFrame, keep: DataFrame | None = None) -> DataFrame:
    """One row for each (file, platform, minute): centroid, readings, speed, band.

    A reading repeated in its file counts once; rows without a usable time or position are skipped. Speed is taken to the
    minute before, else to the one after, across gaps of GAP_S at most.
    """
    if keep is not None:
        readings = readings.join(keep.select("file", "unique_id"), ["file", "unique_id"], "left_semi")
    points = readings.select("file", F.col("unique_id").alias("platform"), "provider", "key", parse_time(F.col("time")).alias("t"), F.col("lon_d").alias("lon"), F.col("lat_d").alias("lat")).distinct()
    usable = points.where(F.col("t").isNotNull() & grid.valid(F.col("lat"), F.col("lon")))
    each = usable.groupBy("file", "platform", F.date_trunc("minute", "t").alias("m")).agg(
        F.min("provider").alias("provider"), F.count("*").cast("int").alias("n"), F.avg("lon").alias("lon"), F.avg("lat").alias("lat")
    )
    track = Window.partitionBy("file", "platform").orderBy("m")
    near = each.withColumns({f"{c}{k}": f(c).over(track) for c in ("m", "lon", "lat") for k, f in ((0, F.lag), (1, F.lead))})
    back, ahead = F.unix_seconds("m") - F.unix_seconds("m0"), F.unix_seconds("m1") - F.unix_seconds("m")
    c = F.col
    speed = F.when(back <= GAP_S, knots(c("lat0"), c("lon0"), c("lat"), c("lon"), back)).when(ahead <= GAP_S, knots(c("lat"), c("lon"), c("lat1"), c("lon1"), ahead))
    kn = c("kn")
    band = F.when(kn.isNull(), "isolated").when(kn >= GLITCH, "glitch").when(kn < STATIONARY, "stationary").when(kn < SLOW, "slow").otherwise("underway")
    made = near.withColumn("kn", speed).withColumn("band", band)
    return made.select("file", "platform", "provider", "m", "n", "lon", "lat", kn.cast("float").alias("kn"), "band")


def underway(minute_rows: DataFrame, with_file: bool = False) -> DataFrame:
    """Minutes of each band by (provider, platform, day, cell of the centroid)."""
    band = lambda *names: F.count_if(F.col("band").isin(*names))
    keys = [*(["file"] if with_file else []), "provider", "platform", day_text(F.col("m")).alias("day"), grid.cell(F.col("lat"), F.col("lon"), RES).alias(f"h3_r{RES}")]
    return minute_rows.groupBy(*keys).agg(
        band("underway").alias("min_underway"), band("slow").alias("min_slow"), band("stationary").alias("min_stationary"), band("isolated", "glitch").alias("min_other"), F.sum("n").cast("long").alias("n_soundings")
    )
