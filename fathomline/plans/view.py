"""The driver's tables seen as an archive: readings, groups, state tables and listings, in both dialects.

Each function has its SQL twin, which DuckDB runs over the same tables; operators are then applied to the view, and the
oracles spell the operators out in SQL over the twins.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomline.functions import grid
from fathomline.functions.identity import key
from fathomline.functions.scalars import month_of

NOW = datetime(2024, 2, 11)
START_S = 1_706_745_600  # 2024-02-01 00:00 UTC: the first file's stamp
FILES, STEP_S = 40, 21_600


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as keyed readings. Identity leaves the platform out, so that copies of every class occur."""
    e = table(spark, sf_dir, "events")
    day = F.date_format("ts", "yyyy-MM-dd")
    return e.select(
        "event_id",
        F.concat(F.lit("f"), F.lpad((F.col("event_id") % FILES).cast("string"), 2, "0")).alias("file"),
        F.concat(F.lit("P"), (F.col("user_id") % 5).cast("string")).alias("unique_id"),
        F.col("event_type").alias("provider"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("time"),
        key(F.col("event_type"), day, F.floor(F.col("value") / 10)).alias("key"),
        month_of(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("coll_month"),
        F.timestamp_seconds(F.lit(START_S) + (F.col("event_id") % FILES) * STEP_S).alias("ingested"),
        ((F.col("user_id") * 37) % 360 - 180 + F.col("value") / 1000).alias("lon_d"),
        ((F.col("user_id") * 17) % 160 - 80 + F.col("value") / 1000).alias("lat_d"),
        F.col("value").alias("depth"),
    )


def lattice(res: int, lat: str = "lat_d", lon: str = "lon_d") -> str:
    nx, ny = 1 << (res + grid.X_BITS), 1 << (res + grid.Y_BITS)
    return (
        f"CASE WHEN {lat} BETWEEN -90 AND 90 AND {lon} BETWEEN -180 AND 180 THEN CAST({res} * power(2, 56) AS BIGINT)"
        f" + CAST(least(floor(({lon} + 180.0) / 360.0 * {nx}), {nx - 1}) AS BIGINT) * 268435456 + CAST(least(floor(({lat} + 90.0) / 180.0 * {ny}), {ny - 1}) AS BIGINT) END"
    )


def up(cell: str, fine: int, res: int) -> str:
    by = 1 << (fine - res)
    x, y = f"(({cell}) // 268435456) % 268435456", f"({cell}) % 268435456"
    return f"(CAST({res} * power(2, 56) AS BIGINT) + ({x}) // {by} * 268435456 + ({y}) // {by})"


def lon_of(cell: str, res: int) -> str:
    return f"(((({cell}) // 268435456) % 268435456) + 0.5) * 360.0 / {1 << (res + grid.X_BITS)} - 180.0"


def lat_of(cell: str, res: int) -> str:
    return f"((({cell}) % 268435456) + 0.5) * 180.0 / {1 << (res + grid.Y_BITS)} - 90.0"


READINGS = f"""readings AS (
  SELECT event_id, 'f' || lpad(CAST(event_id % {FILES} AS VARCHAR), 2, '0') AS file, 'P' || CAST(user_id % 5 AS VARCHAR) AS unique_id, event_type AS provider,
         strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS time,
         md5(concat_ws('|', coalesce(event_type, ''), coalesce(strftime(ts, '%Y-%m-%d'), ''), coalesce(CAST(CAST(floor(value / 10) AS BIGINT) AS VARCHAR), ''))) AS key,
         strftime(ts, '%Y-%m') AS coll_month, TIMESTAMP '2024-02-01' + to_seconds(event_id % {FILES} * {STEP_S}) AS ingested,
         user_id * 37 % 360 - 180 + value / 1000 AS lon_d, user_id * 17 % 160 - 80 + value / 1000 AS lat_d, value AS depth
  FROM events)"""

CLASSIFIED = f"""{READINGS}, classified AS (
  SELECT *, CASE WHEN row_number() OVER w = 1 THEN 'unique' WHEN first_value(unique_id) OVER w = unique_id THEN 'dup_resend' ELSE 'dup_cross_id' END AS class
  FROM readings WINDOW w AS (PARTITION BY key ORDER BY ingested NULLS LAST, file NULLS LAST, unique_id NULLS LAST, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""

TALLIES = """CAST(count(*) AS BIGINT) AS n_rows, CAST(count(*) FILTER (WHERE class = 'unique') AS BIGINT) AS n_unique,
  CAST(count(*) FILTER (WHERE class = 'dup_resend') AS BIGINT) AS n_dup_resend, CAST(count(*) FILTER (WHERE class = 'dup_cross_id') AS BIGINT) AS n_dup_cross_id"""
