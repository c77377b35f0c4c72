"""Map levels: roll-ups of live cells, vessel-days and minutes at coarser resolutions, tiles, nearest cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathomline.functions import grid
from fathomline.functions.scalars import boundaries, round_at, share_of_duplicates

# Parent level of a level's tiles, and padding of a tile's box in degrees.
PARENT = {4: None, 6: 1, 8: 2, 9: 3}
PADDING = {4: 0.3, 6: 0.05, 8: 0.01, 9: 0.005}


def hours(minutes: str) -> Column:
    return round_at(F.sum(minutes) / 60.0, 2)


def cells_at(cells: DataFrame, res: int) -> DataFrame:
    """Readings for each cell: counts, share of duplicates, providers, years."""
    year = F.left("coll_month", F.lit(4))
    rows = cells.withColumn("cell", grid.parent(F.col("h3"), res))
    by_provider = rows.groupBy("cell", "provider").agg(F.sum("n_unique").alias("u"), F.sum("n_rows").alias("r"), F.min(year).alias("y0"), F.max(year).alias("y1"), F.min("coll_month").alias("m0"))
    made = by_provider.groupBy("cell").agg(
        F.sum("u").cast("long").alias("n_unique"), F.sum("r").cast("long").alias("n_published"), F.count("provider").cast("int").alias("n_providers"),
        F.min("y0").cast("int").alias("first_year"), F.max("y1").cast("int").alias("last_year"), F.min("m0").alias("first_month"),
    )
    share = share_of_duplicates(F.col("n_unique"), F.col("n_published")).alias("dup_share")
    return made.select("cell", "n_unique", "n_published", share, "n_providers", "first_year", "last_year", "first_month")


def vessels_at(vessel_days: DataFrame, res: int) -> DataFrame:
    """Vessel-days and platforms for each cell: distinct (platform, day), recomputed from the keys at every level."""
    rows = vessel_days.withColumn("cell", grid.parent(F.col("h3"), res))
    by_day = rows.groupBy("cell", "platform", "day").agg(F.sum("n_unique").alias("u"), F.sum("n_rows").alias("r"))
    by_platform = by_day.groupBy("cell", "platform").agg(F.count_if(F.col("platform").isNotNull() & F.col("day").isNotNull()).alias("d"), F.sum("u").alias("u"), F.sum("r").alias("r"))
    return by_platform.groupBy("cell").agg(
        F.sum("d").cast("int").alias("vessel_days"), F.count("platform").cast("int").alias("platforms"), F.sum("u").cast("long").alias("n_unique"), F.sum("r").cast("long").alias("n_published")
    )


def hours_at(minutes: DataFrame, res: int) -> DataFrame:
    return minutes.groupBy(grid.parent(F.col("h3"), res).alias("cell")).agg(hours("min_underway").alias("underway_h"), hours("min_stationary").alias("stationary_h"))


def _zero(kind: str, *names: str) -> list[Column]:
    return [F.coalesce(n, F.lit(0)).cast(kind).alias(n) for n in names]


def archive_level(cells: DataFrame, vessel_days: DataFrame, minutes: DataFrame, res: int) -> DataFrame:
    base = cells_at(cells, res)
    v = vessels_at(vessel_days, res).select("cell", "vessel_days", "platforms")
    joined = base.join(v, "cell", "left").join(hours_at(minutes, res), "cell", "left")
    return joined.select(*base.columns, *_zero("int", "vessel_days", "platforms"), *_zero("double", "underway_h", "stationary_h"))


def in_window(df: DataFrame, today: str, days: int) -> DataFrame:
    """Rows whose day (text) lies in the `days` days up to `today`."""
    from datetime import date, timedelta

    since = (date.fromisoformat(today) - timedelta(days=days)).isoformat()
    return df.where((F.col("day") > since) & (F.col("day") <= today))


def window_level(vessel_days: DataFrame, minutes: DataFrame, res: int) -> DataFrame:
    """A collection window's cells; the inputs are cut to the window already."""
    joined = vessels_at(vessel_days, res).join(hours_at(minutes, res), "cell", "full")
    return joined.select("cell", *_zero("int", "vessel_days", "platforms"), *_zero("long", "n_unique", "n_published"), *_zero("double", "underway_h", "stationary_h"))


def recent_rows(recent: DataFrame, now: Column, undated_as_null: bool = False) -> DataFrame:
    """Rows of files published in the last day, with the readings' age at publication in days.

    A row without a date has age 0, as the least age there is; or null, if so wished.
    """
    age = boundaries("minute", F.col("day").try_cast("date").cast("timestamp"), F.col("ingested")) / 1440.0
    age = F.when(age.isNotNull(), F.greatest(F.lit(0.0), age)) if undated_as_null else F.greatest(F.lit(0.0), age)
    cut = recent.where(F.col("ingested") >= now - F.expr("interval 1 day"))
    return cut.select("unique_id", "day", F.col("h3_r9").alias("h3"), "n_rows", "n_unique", age.alias("age_d"))


def last24_level(rows: DataFrame, minutes: DataFrame, res: int) -> DataFrame:
    at = rows.where(F.col("h3").isNotNull()).withColumn("cell", grid.parent(F.col("h3"), res))
    dated = F.col("age_d").isNotNull()
    by_platform = at.groupBy("cell", "unique_id").agg(
        F.sum("n_unique").alias("u"), F.sum("n_rows").alias("r"), F.min(F.when(dated, F.col("day"))).alias("d0"), F.max(F.when(dated, F.col("day"))).alias("d1"),
        F.sum(F.col("n_rows") * F.col("age_d")).alias("aged"), F.sum(F.when(dated, F.col("n_rows"))).alias("weight"),
    )
    base = by_platform.groupBy("cell").agg(
        F.sum("u").cast("long").alias("n_unique"), F.sum("r").cast("long").alias("n_published"), F.count("unique_id").cast("int").alias("platforms"), F.min("d0").alias("first_day"), F.max("d1").alias("last_day"),
        round_at(F.sum("aged") / F.nullif(F.sum("weight"), F.lit(0)), 1).alias("mean_age_d"),
    )
    return base.join(hours_at(minutes, res).select("cell", "underway_h"), "cell", "left").select(*base.columns, *_zero("double", "underway_h"))


def levels(cells: DataFrame, resolutions: tuple[int, ...]) -> DataFrame:
    """Counts of several levels in one pass: each live cell is exploded into its parents."""
    parents = F.array(*(F.struct(F.lit(r).alias("res"), grid.parent(F.col("h3"), r).alias("cell")) for r in resolutions))
    return cells.select(F.explode(parents).alias("p"), "n_rows", "n_unique").groupBy("p.res", "p.cell").agg(F.sum("n_rows").cast("long").alias("n_published"), F.sum("n_unique").cast("long").alias("n_unique"))


def first_seen(cells: DataFrame, res: int = 8) -> DataFrame:
    return cells.groupBy(grid.parent(F.col("h3"), res).alias("cell")).agg(F.min("coll_month").alias("month"))


def reach_series(cells: DataFrame, minutes: DataFrame) -> DataFrame:
    """By month: hours underway, and cells first covered then."""
    new = first_seen(cells).groupBy("month").agg(F.count("*").alias("new_cells_r8"))
    spent = minutes.groupBy(F.left("day", F.lit(7)).alias("month")).agg(round_at(F.sum("min_underway") / 60.0, 1).alias("underway_h"))
    return new.join(spent, "month", "full").select("month", *_zero("double", "underway_h"), *_zero("long", "new_cells_r8"))


def tiles(level_rows: DataFrame, res: int) -> DataFrame:
    """One row for each tile of a level: its parent's text, rows and padded box."""
    up, pad = PARENT[res], PADDING[res]
    part = F.lit("all") if up is None else grid.to_string(grid.parent(F.col("cell"), up))
    lon, lat = grid.center_lon(F.col("cell")), grid.center_lat(F.col("cell"))
    box = level_rows.groupBy(part.alias("part")).agg(F.count("*").alias("rows"), F.min(lon).alias("w"), F.min(lat).alias("s"), F.max(lon).alias("e"), F.max(lat).alias("n"))
    wide = F.col("e") - F.col("w") > 180
    west, east = F.when(wide, -180.0).otherwise(F.col("w")), F.when(wide, 180.0).otherwise(F.col("e"))
    low = lambda v, least: round_at(F.greatest(F.lit(least), v - pad), 4)
    high = lambda v, most: round_at(F.least(F.lit(most), v + pad), 4)
    return box.select(F.lit(res).alias("res"), "part", "rows", low(west, -180.0).alias("west"), low(F.col("s"), -90.0).alias("south"), high(east, 180.0).alias("east"), high(F.col("n"), 90.0).alias("north"))


def viewport(manifest: DataFrame, res: int, west: float, south: float, east: float, north: float) -> DataFrame:
    """Tiles of a level that a map view touches."""
    return manifest.where((F.col("res") == res) & (F.col("west") <= east) & (F.col("east") >= west) & (F.col("south") <= north) & (F.col("north") >= south))


def resolution_of(zoom: float) -> int:
    return 4 if zoom < 5 else 6 if zoom < 8 else 8 if zoom < 10 else 9


BUCKETS = 160


def nearest(points: DataFrame, cells: DataFrame, most: float, buckets: int = BUCKETS) -> DataFrame:
    """The nearest of `cells` (cell, x, y in 0..1) to each of `points` (id, x, y), within `most`.

    Points are exploded into the nine buckets around them; `most` must not exceed a bucket's width.
    """
    if most > 1 / buckets:
        raise ValueError("the distance exceeds a bucket")
    bucket = lambda c: F.least(F.floor(c * buckets), F.lit(buckets - 1))
    near = F.array(*(F.struct((bucket(F.col("x")) + i).alias("bx"), (bucket(F.col("y")) + j).alias("by")) for i in (-1, 0, 1) for j in (-1, 0, 1)))
    asked = points.select("id", "x", "y", F.explode(near).alias("b")).select("id", "x", "y", "b.bx", "b.by")
    held = cells.select("cell", F.col("x").alias("cx"), F.col("y").alias("cy"), bucket(F.col("x")).alias("bx"), bucket(F.col("y")).alias("by"))
    squared = (F.col("x") - F.col("cx")) * (F.col("x") - F.col("cx")) + (F.col("y") - F.col("cy")) * (F.col("y") - F.col("cy"))
    found = asked.join(held, ["bx", "by"]).withColumn("d2", squared).where(F.col("d2") <= most * most)
    return found.groupBy("id").agg(F.min(F.struct("d2", "cell")).alias("b")).select("id", F.col("b.cell").alias("cell"), F.sqrt("b.d2").alias("distance"))


def trailing_mean(series: DataFrame, by: list[str], order: str, value: str, k: int) -> DataFrame:
    """Mean over a point and the k - 1 points before it."""
    over = Window.partitionBy(*by).orderBy(order).rowsBetween(-(k - 1), 0)
    return series.withColumn("mean", F.avg(value).over(over))


def run_lengths(samples: DataFrame, by: list[str], order: str, value: str) -> DataFrame:
    """Gaps and islands: stretches of equal values in order, with first position and length."""
    line, same = Window.partitionBy(*by).orderBy(order), Window.partitionBy(*by, value).orderBy(order)
    rows = samples.withColumn("_i", F.row_number().over(line)).withColumn("_g", F.col("_i") - F.row_number().over(same))
    return rows.groupBy(*by, value, "_g").agg(F.min("_i").cast("long").alias("first"), F.count("*").alias("length")).drop("_g")
