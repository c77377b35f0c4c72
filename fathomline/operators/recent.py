"""Recent activity by publication and by collection, latency, totals."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathomline.functions import grid
from fathomline.functions.scalars import boundaries, day_text, parse_time, round_at

# Windows of publication in days, and limits of lag (hours) and age (days).
STRIP = {"24h": 1, "7d": 7, "30d": 30, "all": None}
LAGS = {"<6h": 6, "6-24h": 24, "1-3d": 72, "3-7d": 168, "7-30d": 720, "30-365d": 8760, ">1y": None}
AGES = {"this week": 7, "this month": 30, "this year": 365, "older": None, "no date": None}


def moment(t: datetime) -> Column:
    return F.lit(t.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")


def published(index: DataFrame, undated_as_null: bool = False) -> DataFrame:
    """Live groups with the lag of their newest reading in hours, and their platform's first appearance."""
    lag = boundaries("second", parse_time(F.col("t_max")), F.col("ingested")) / 3600.0
    lag = F.when(lag.isNotNull(), F.greatest(F.lit(0.0), lag)) if undated_as_null else F.greatest(F.lit(0.0), lag)
    live = index.where("status = 'live'")
    first = live.groupBy("unique_id").agg(F.min("ingested").alias("first_seen")).withColumnRenamed("unique_id", "_id")
    rows = live.select("file", "unique_id", "provider", "ingested", "n_rows", "n_unique", lag.alias("lag_h"))
    return rows.join(first, F.col("unique_id").eqNullSafe(F.col("_id"))).drop("_id")


def since(rows: DataFrame, now: datetime, days: int | None) -> DataFrame:
    return rows if days is None else rows.where(F.col("ingested") >= moment(now - timedelta(days=days)))


def strip(rows: DataFrame, now: datetime, by: list[str] | None = None) -> DataFrame:
    """For each window of publication: files, readings, platforms, new platforms, providers, median lag."""
    by = by or []
    names = [(n, d) for n, d in STRIP.items()]
    # Windows are nested: a row counts in every window that reaches it.
    reach = F.filter(F.array(*(F.struct(F.lit(n).alias("window"), (F.lit(True) if d is None else F.col("ingested") >= moment(now - timedelta(days=d))).alias("in")) for n, d in names)), lambda w: w["in"])
    spread = rows.withColumn("window", F.explode(F.transform(reach, lambda w: w["window"])))
    return spread.groupBy(*by, "window").agg(
        F.count_distinct("file").alias("files"), F.sum("n_rows").cast("long").alias("published"), F.sum("n_unique").cast("long").alias("unique"), F.count_distinct("unique_id").alias("platforms"),
        F.count_distinct(F.when(F.col("first_seen") == F.col("ingested"), F.col("unique_id"))).alias("new_platforms"), F.count_distinct("provider").alias("providers"), round_at(F.median("lag_h"), 1).alias("median_lag_h"),
    )


def batches(rows: DataFrame, hours: int = 6) -> DataFrame:
    return rows.groupBy(F.window("ingested", f"{hours} hours")["start"].alias("batch")).agg(F.count_distinct("file").alias("files"), F.sum("n_rows").cast("long").alias("published"), F.sum("n_unique").cast("long").alias("unique"))


def daily_published(rows: DataFrame) -> DataFrame:
    return rows.groupBy(day_text(F.col("ingested")).alias("day")).agg(
        F.count_distinct("file").alias("files"), F.sum("n_rows").cast("long").alias("published"), F.sum("n_unique").cast("long").alias("unique"), F.count_distinct("unique_id").alias("platforms")
    )


def daily_collected(vessel_days: DataFrame) -> DataFrame:
    return vessel_days.groupBy("day").agg(F.sum("n_rows").cast("long").alias("published"), F.sum("n_unique").cast("long").alias("unique"), F.count_distinct("platform").alias("platforms"), F.count("*").alias("vessel_cells"))


def bucket_of(value: Column, limits: dict[str, int | None]) -> Column:
    ends = [(n, m) for n, m in limits.items() if m is not None]
    last = [n for n, m in limits.items() if m is None and n != "no date"][0]
    out = F.when(value.isNull(), F.lit("no date")) if "no date" in limits else None
    for name, most in ends:
        out = F.when(value < most, F.lit(name)) if out is None else out.when(value < most, F.lit(name))
    return out.otherwise(F.lit(last))


def histogram(rows: DataFrame, value: str, limits: dict[str, int | None], weight: Column | None = None) -> DataFrame:
    """Every bucket in order, with 0 where nothing falls."""
    counted = rows.groupBy(bucket_of(F.col(value), limits).alias("bucket")).agg((F.count("*") if weight is None else F.sum(weight)).cast("long").alias("n"))
    names = rows.sparkSession.createDataFrame([(i, n) for i, n in enumerate(limits)], "place int, bucket string")
    return names.join(counted, "bucket", "left").select("place", "bucket", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def latency(runs: DataFrame, now: datetime) -> DataFrame:
    """One row: the last batch's publication, its latency in minutes, and the median of 30 days."""
    for c in ("newest_published", "finished_at"):
        if c not in runs.columns:
            runs = runs.withColumn(c, F.lit(None).cast("timestamp"))
    taken = runs.where("kind = 'incremental' AND new_files > 0 AND newest_published IS NOT NULL AND finished_at IS NOT NULL")
    rows = taken.select("newest_published", "finished_at", (boundaries("second", F.col("newest_published"), F.col("finished_at")) / 60.0).alias("minutes"))
    last = F.max(F.struct("finished_at", "newest_published", "minutes"))
    fresh = F.when(F.col("finished_at") >= moment(now - timedelta(days=30)), F.col("minutes"))
    made = rows.agg(last.alias("l"), F.round(F.median(fresh)).cast("long").alias("median_latency_min_30d"))
    return made.select(F.col("l.newest_published").alias("last_batch_published"), F.round(F.col("l.minutes")).cast("long").alias("last_latency_min"), "median_latency_min_30d")


def newest_runs(runs: DataFrame, n: int = 120) -> DataFrame:
    return runs.orderBy(F.desc_nulls_last("run_at"), "run_id").limit(n)


def month_series(months: DataFrame, index: DataFrame, by_provider: bool = False) -> DataFrame:
    live = index.where("status = 'live'").select("file", "unique_id", "provider")
    keys = [F.col("coll_month").alias("month"), *([F.col("provider")] if by_provider else [])]
    joined = months.where("coll_month <> 'invalid'").join(live, ["file", "unique_id"])
    total = lambda c, n: F.sum(c).cast("long").alias(n)
    return joined.groupBy(*keys).agg(total("n_rows", "published"), total("n_unique", "unique"), total("n_dup_resend", "dup_resend"), total("n_dup_cross_id", "dup_cross_id"))


def platform_days(minutes: DataFrame) -> DataFrame:
    """One row: hours by band over platform-days, and how many platform-days never move."""
    each = minutes.groupBy("platform", "day").agg(F.sum("min_underway").alias("u"), F.sum("min_stationary").alias("s"))
    made = each.agg(F.round(F.sum("u") / 60.0).cast("long").alias("underway_hours"), F.round(F.sum("s") / 60.0).cast("long").alias("stationary_hours"), F.count("*").alias("platform_days_logged"), F.count_if(F.col("u") == 0).alias("platform_days_never_underway"))
    share = round_at(F.try_divide(F.col("platform_days_never_underway").cast("double"), F.col("platform_days_logged").cast("double")), 4)
    return made.withColumn("share_never_underway", share)


def reach_since(cells: DataFrame, today: str) -> DataFrame:
    month = f"{int(today[:4]) - 1:04d}-{today[5:7]}"
    first = cells.groupBy(grid.parent(F.col("h3"), 8).alias("cell")).agg(F.min("coll_month").alias("first"))
    return first.agg(F.count_if(F.col("first") > month).alias("reach_cells_12m"))


def totals(index: DataFrame) -> DataFrame:
    live = index.where("status = 'live'")
    sums = [F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(n) for c, n in (("n_rows", "published"), ("n_unique", "unique"), ("n_dup_resend", "dup_resend"), ("n_dup_cross_id", "dup_cross_id"))]
    return live.agg(*sums, F.count_distinct("file").alias("files"), F.count_distinct("provider").alias("providers"), F.count_distinct("unique_id").alias("platforms"), F.max("ingested").alias("last_ingested"))


def first_of_each(rows: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where("_n = 1").drop("_n")
