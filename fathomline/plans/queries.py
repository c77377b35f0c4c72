"""Every operator as a query over the driver's tables, beside the SQL that gives the same rows."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomline.functions import grid, scalars
from fathomline.operators import levels, match, recent, region, rollup, tracks
from fathomline.operators.classify import classify, summed, tallies
from fathomline.plans import census, incremental, reconcile, seed
from fathomline.plans.ledger import Ledger, push
from fathomline.plans.work import Work
from fathomline.plans.view import CLASSIFIED, NOW, READINGS, TALLIES, lat_of, lattice, lon_of, readings, table, up
from fathomline.sources.archives import AsOf, Tables
from fathomline.sources.files import Files
from fathomline.sources.readings import keyed
from fathomline.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def ts(name: str) -> F.Column:
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)


def sql_ts(expression: str, name: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S') AS {name}"


TODAY = "2024-01-25"
NOW_SQL = f"TIMESTAMP '{NOW:%Y-%m-%d %H:%M:%S}'"
SUMS = "CAST(sum(n_rows) AS BIGINT) AS n_rows, CAST(sum(n_unique) AS BIGINT) AS n_unique, CAST(sum(n_dup_resend) AS BIGINT) AS n_dup_resend, CAST(sum(n_dup_cross_id) AS BIGINT) AS n_dup_cross_id"


def ratio(n: str, d: str) -> str:
    return f"round((1 - ({n}) / ({d})) * 10000) / 10000"


# Identity and classes.


@query(f"WITH {CLASSIFIED} SELECT provider, left(time, 10) AS day, {TALLIES} FROM classified GROUP BY ALL")
def classify_daily(spark, sf):
    return classify(readings(spark, sf)).groupBy("provider", F.left("time", F.lit(10)).alias("day")).agg(*tallies())


@query(f"""WITH d AS (SELECT md5(text) AS key, source AS unique_id, doc_id FROM documents), classified AS (
  SELECT *, CASE WHEN row_number() OVER w = 1 THEN 'unique' WHEN first_value(unique_id) OVER w = unique_id THEN 'dup_resend' ELSE 'dup_cross_id' END AS class
  FROM d WINDOW w AS (PARTITION BY key ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT unique_id AS source, {TALLIES} FROM classified GROUP BY ALL""")
def classify_documents(spark, sf):
    d = table(spark, sf, "documents").select(F.md5("text").alias("key"), F.col("source").alias("unique_id"), "doc_id")
    return classify(d, ("doc_id", "unique_id")).groupBy(F.col("unique_id").alias("source")).agg(*tallies())


@query(f"""WITH {READINGS}, early AS (SELECT * FROM readings WHERE ingested < TIMESTAMP '2024-02-06'), classified AS (
  SELECT *, CASE WHEN row_number() OVER w = 1 THEN 'unique' WHEN first_value(unique_id) OVER w = unique_id THEN 'dup_resend' ELSE 'dup_cross_id' END AS class
  FROM early WINDOW w AS (PARTITION BY key ORDER BY ingested, file, unique_id, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT provider, {TALLIES} FROM classified GROUP BY ALL""")
def classify_as_of(spark, sf):
    early = readings(spark, sf).where(F.col("ingested") < F.lit("2024-02-06").cast("timestamp"))
    return classify(early).groupBy("provider").agg(*tallies())


@query(f"WITH {CLASSIFIED} SELECT file, unique_id, {TALLIES} FROM classified GROUP BY ALL")
def file_counts(spark, sf):
    return rollup.file_counts(classify(readings(spark, sf)))


META_SQL = """meta AS (SELECT file, unique_id, min(provider) AS provider, CAST(count(*) AS BIGINT) AS n_rows, min(time) AS t_min, max(time) AS t_max,
  min(lon_d) AS lon_min, max(lon_d) AS lon_max, min(lat_d) AS lat_min, max(lat_d) AS lat_max,
  CAST(CAST(sum(md5_number_lower(concat_ws('|', provider, left(time, 10), CAST(CAST(floor(depth / 10) AS BIGINT) AS VARCHAR)))) AS HUGEINT) % 18446744073709551616::HUGEINT AS VARCHAR) AS fingerprint, min(ingested) AS ingested
  FROM readings GROUP BY file, unique_id)"""


@query(f"WITH {READINGS}, {META_SQL} SELECT file, unique_id, provider, n_rows, t_min, t_max, lon_min, lon_max, lat_min, lat_max, {sql_ts('ingested', 'ingested')} FROM meta")
def group_metadata(spark, sf):
    return rollup.group_meta(readings(spark, sf)).drop("fingerprint").withColumn("ingested", ts("ingested"))


@query(f"WITH {READINGS}, {META_SQL} SELECT file, unique_id, fingerprint FROM meta")
def fingerprint(spark, sf):
    return rollup.group_meta(readings(spark, sf)).select("file", "unique_id", F.col("fingerprint").cast("string").alias("fingerprint"))


def _again(df):
    """Readings delivered again in later files: whole files of the first ten."""
    late = df.where(F.col("file") < "f10").withColumns({"file": F.concat(F.lit("z"), "file"), "ingested": F.col("ingested") + F.expr("interval 30 days")})
    return late


@query(f"""WITH {READINGS}, {META_SQL}, again AS (SELECT 'z' || file AS file, unique_id, n_rows, fingerprint FROM meta WHERE file < 'f10'), m AS (
  SELECT a.file, a.unique_id, i.file AS dup_of, i.unique_id AS dup_uid, row_number() OVER (PARTITION BY a.file, a.unique_id ORDER BY i.ingested, i.file, i.unique_id) AS n
  FROM again a JOIN meta i ON i.fingerprint = a.fingerprint AND i.n_rows = a.n_rows)
SELECT file, unique_id, dup_of, dup_uid FROM m WHERE n = 1""")
def fingerprint_match(spark, sf):
    rows = readings(spark, sf)
    return match.fingerprint_matches(rollup.group_meta(_again(rows)), rollup.group_meta(rows).withColumn("status", F.lit("live")))


@query(f"""WITH {CLASSIFIED}, {META_SQL}, c AS (SELECT file, unique_id, {TALLIES} FROM classified GROUP BY ALL)
SELECT m.file, m.unique_id, m.provider, m.n_rows, m.t_min, m.t_max, m.fingerprint, c.n_unique, c.n_dup_resend, c.n_dup_cross_id FROM meta m JOIN c USING (file, unique_id)""")
def file_index(spark, sf):
    rows = readings(spark, sf)
    index = rollup.finalize(rollup.group_meta(rows), rollup.file_month_counts(classify(rows)))
    return index.select("file", "unique_id", "provider", "n_rows", "t_min", "t_max", F.col("fingerprint").cast("string").alias("fingerprint"), "n_unique", "n_dup_resend", "n_dup_cross_id")


# Roll-ups.


@query(f"WITH {CLASSIFIED} SELECT provider, left(time, 10) AS coll_day, {lattice(5)} AS h3_r5, {TALLIES}, CAST(count(DISTINCT unique_id) AS BIGINT) AS platforms FROM classified GROUP BY ALL")
def daily_cells(spark, sf):
    return rollup.daily(classify(readings(spark, sf)))


@query(f"WITH {CLASSIFIED} SELECT provider, coll_month, {lattice(9)} AS h3_r9, {TALLIES} FROM classified GROUP BY ALL")
def month_cells(spark, sf):
    return rollup.month_cells(classify(readings(spark, sf)))


VESSEL_SQL = f"vd AS (SELECT provider, unique_id AS platform, left(time, 10) AS day, {lattice(8)} AS h3_r8, {TALLIES} FROM classified WHERE {lattice(8)} IS NOT NULL GROUP BY ALL)"
LIVE_SQL = f"""{CLASSIFIED}, {VESSEL_SQL}, live_vd AS (SELECT provider, platform, day, h3_r8 AS h3, n_rows, n_unique FROM vd WHERE n_rows - n_dup_cross_id > 0),
cells AS (SELECT provider, coll_month, {lattice(9)} AS h3, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(*) FILTER (WHERE class = 'unique') AS BIGINT) AS n_unique FROM classified WHERE {lattice(9)} IS NOT NULL GROUP BY ALL)"""
_HAVERSINE = "2.0 * 6371000 * asin(sqrt(pow(sin(radians({b} - {a}) / 2), 2) + cos(radians({a})) * cos(radians({b})) * pow(sin(radians({d} - {c}) / 2), 2))) / ({s}) * 1.943844"
MINUTES_SQL = f"""pts AS (SELECT DISTINCT file, unique_id AS platform, provider, key, CAST(left(time, 19) AS TIMESTAMP) AS t, lon_d AS lon, lat_d AS lat FROM readings),
mins AS (SELECT file, platform, min(provider) AS provider, date_trunc('minute', t) AS m, CAST(count(*) AS INTEGER) AS n, avg(lon) AS lon, avg(lat) AS lat FROM pts WHERE lon BETWEEN -180 AND 180 AND lat BETWEEN -90 AND 90 GROUP BY file, platform, date_trunc('minute', t)),
near AS (SELECT *, lag(m) OVER w AS m0, lag(lon) OVER w AS lon0, lag(lat) OVER w AS lat0, lead(m) OVER w AS m1, lead(lon) OVER w AS lon1, lead(lat) OVER w AS lat1 FROM mins WINDOW w AS (PARTITION BY file, platform ORDER BY m)),
sped AS (SELECT *, CASE WHEN epoch(m) - epoch(m0) <= 300 THEN {_HAVERSINE.format(a='lat0', b='lat', c='lon0', d='lon', s='epoch(m) - epoch(m0)')} WHEN epoch(m1) - epoch(m) <= 300 THEN {_HAVERSINE.format(a='lat', b='lat1', c='lon', d='lon1', s='epoch(m1) - epoch(m)')} END AS kn FROM near),
banded AS (SELECT *, CASE WHEN kn IS NULL THEN 'isolated' WHEN kn >= 60 THEN 'glitch' WHEN kn < 0.5 THEN 'stationary' WHEN kn < 2 THEN 'slow' ELSE 'underway' END AS band FROM sped)"""
UNDERWAY_SQL = f"""uw AS (SELECT provider, platform, strftime(m, '%Y-%m-%d') AS day, {lattice(8, 'lat', 'lon')} AS h3_r8,
  CAST(count(*) FILTER (WHERE band = 'underway') AS BIGINT) AS min_underway, CAST(count(*) FILTER (WHERE band = 'slow') AS BIGINT) AS min_slow, CAST(count(*) FILTER (WHERE band = 'stationary') AS BIGINT) AS min_stationary,
  CAST(count(*) FILTER (WHERE band IN ('isolated', 'glitch')) AS BIGINT) AS min_other, CAST(sum(n) AS BIGINT) AS n_soundings FROM banded GROUP BY ALL)"""
HOURS = "round(CAST(sum(min_underway) AS DOUBLE) / 60.0 * 100) / 100 AS underway_h, round(CAST(sum(min_stationary) AS DOUBLE) / 60.0 * 100) / 100 AS stationary_h"


@query(f"WITH {CLASSIFIED}, {VESSEL_SQL} SELECT * FROM vd")
def vessel_days(spark, sf):
    return rollup.vessel_days(classify(readings(spark, sf)))


def _live(spark, sf):
    rows = readings(spark, sf)
    classified = classify(rows).persist()  # cells and vessel-days read it; a session's cache is cleared by its owner
    minutes = rollup.live_minutes(tracks.underway(tracks.minutes(rows)))
    return rollup.live_cells(rollup.month_cells(classified)), rollup.live_vessel_days(rollup.vessel_days(classified)), minutes


@query(f"WITH {LIVE_SQL} SELECT {up('h3', 8, 6)} AS cell, CAST(count(DISTINCT platform || '|' || day) AS INTEGER) AS vessel_days, CAST(count(DISTINCT platform) AS INTEGER) AS platforms, CAST(sum(n_unique) AS BIGINT) AS n_unique, CAST(sum(n_rows) AS BIGINT) AS n_published FROM live_vd GROUP BY 1")
def vessel_days_live(spark, sf):
    return levels.vessels_at(_live(spark, sf)[1], 6)


@query(f"WITH {LIVE_SQL} " + " UNION ALL ".join(f"SELECT {r} AS res, {up('h3', 9, r)} AS cell, CAST(sum(n_rows) AS BIGINT) AS n_published, CAST(sum(n_unique) AS BIGINT) AS n_unique FROM cells GROUP BY 2" for r in (4, 6, 8)))
def rollup_levels(spark, sf):
    return levels.levels(_live(spark, sf)[0], (4, 6, 8))


def cells_sql(res: int) -> str:
    return f"""SELECT {up('h3', 9, res)} AS cell, CAST(sum(n_unique) AS BIGINT) AS n_unique, CAST(sum(n_rows) AS BIGINT) AS n_published, {ratio('CAST(sum(n_unique) AS DOUBLE)', 'CAST(sum(n_rows) AS DOUBLE)')} AS dup_share,
  CAST(count(DISTINCT provider) AS INTEGER) AS n_providers, CAST(min(left(coll_month, 4)) AS INTEGER) AS first_year, CAST(max(left(coll_month, 4)) AS INTEGER) AS last_year, min(coll_month) AS first_month FROM cells GROUP BY 1"""


def vessel_sql(res: int, where: str = "") -> str:
    return f"SELECT {up('h3', 8, res)} AS cell, CAST(count(DISTINCT platform || '|' || day) AS INTEGER) AS vessel_days, CAST(count(DISTINCT platform) AS INTEGER) AS platforms, CAST(sum(n_unique) AS BIGINT) AS n_unique, CAST(sum(n_rows) AS BIGINT) AS n_published FROM live_vd {where} GROUP BY 1"


def hours_sql(res: int, where: str = "") -> str:
    return f"SELECT {up('h3_r8', 8, res)} AS cell, {HOURS} FROM uw {where} GROUP BY 1"


def _archive_sql(res: int) -> str:
    return f"""WITH {LIVE_SQL}, {MINUTES_SQL}, {UNDERWAY_SQL} SELECT c.*, coalesce(v.vessel_days, 0) AS vessel_days, coalesce(v.platforms, 0) AS platforms, coalesce(u.underway_h, 0.0) AS underway_h, coalesce(u.stationary_h, 0.0) AS stationary_h
FROM ({cells_sql(res)}) c LEFT JOIN ({vessel_sql(res)}) v USING (cell) LEFT JOIN ({hours_sql(res)}) u USING (cell)"""


@query(_archive_sql(4))
def archive_level(spark, sf):
    return levels.archive_level(*_live(spark, sf), 4)


@query(_archive_sql(6))
def archive_level_r6(spark, sf):
    return levels.archive_level(*_live(spark, sf), 6)


@query(_archive_sql(8))
def archive_level_r8(spark, sf):
    return levels.archive_level(*_live(spark, sf), 8)


@query(f"WITH {LIVE_SQL} {cells_sql(9)}")
def fine_level_r9(spark, sf):
    return levels.cells_at(_live(spark, sf)[0], 9)


def _window_sql(days: int) -> str:
    where = f"WHERE day > strftime(DATE '{TODAY}' - {days}, '%Y-%m-%d') AND day <= '{TODAY}'"
    return f"""WITH {LIVE_SQL}, {MINUTES_SQL}, {UNDERWAY_SQL} SELECT coalesce(v.cell, u.cell) AS cell, coalesce(v.vessel_days, 0) AS vessel_days, coalesce(v.platforms, 0) AS platforms, coalesce(v.n_unique, 0) AS n_unique, coalesce(v.n_published, 0) AS n_published,
coalesce(u.underway_h, 0.0) AS underway_h, coalesce(u.stationary_h, 0.0) AS stationary_h FROM ({vessel_sql(4, where)}) v FULL JOIN ({hours_sql(4, where)}) u ON u.cell = v.cell"""


def _window(spark, sf, days):
    _, vd, uw = _live(spark, sf)
    return levels.window_level(levels.in_window(vd, TODAY, days), levels.in_window(uw, TODAY, days), 4)


@query(_window_sql(7))
def window_level_7d(spark, sf):
    return _window(spark, sf, 7)


@query(_window_sql(30))
def window_level_30d(spark, sf):
    return _window(spark, sf, 30)


@query(_window_sql(365))
def window_level_365d(spark, sf):
    return _window(spark, sf, 365)


LAST24 = "TIMESTAMP '2024-02-10 00:00:00'"


@query(f"""WITH {LIVE_SQL}, {MINUTES_SQL}, f AS (SELECT * FROM classified WHERE ingested >= {LAST24} AND {lattice(9)} IS NOT NULL),
rc AS (SELECT file, unique_id, left(time, 10) AS day, {lattice(9)} AS h3, min(ingested) AS ingested, count(*) AS n_rows, count(*) FILTER (WHERE class = 'unique') AS n_unique FROM f GROUP BY file, unique_id, provider, left(time, 10), {lattice(9)}),
aged AS (SELECT *, greatest(0.0, date_diff('minute', CAST(day AS TIMESTAMP), ingested) / 1440.0) AS age FROM rc),
uf AS (SELECT {lattice(8, 'lat', 'lon')} AS h3_r8, count(*) FILTER (WHERE band = 'underway') AS min_underway, count(*) FILTER (WHERE band = 'stationary') AS min_stationary FROM banded WHERE file IN (SELECT file FROM f) GROUP BY 1),
uw AS (SELECT * FROM uf)
SELECT c.*, coalesce(u.underway_h, 0.0) AS underway_h FROM (SELECT {up('h3', 9, 4)} AS cell, CAST(sum(n_unique) AS BIGINT) AS n_unique, CAST(sum(n_rows) AS BIGINT) AS n_published, CAST(count(DISTINCT unique_id) AS INTEGER) AS platforms, min(day) AS first_day, max(day) AS last_day,
  round(CAST(sum(n_rows * CAST(age AS DOUBLE)) AS DOUBLE) / sum(n_rows) * 10) / 10 AS mean_age_d FROM aged GROUP BY 1) c LEFT JOIN ({hours_sql(4)}) u USING (cell)""")
def last24_level(spark, sf):
    rows = readings(spark, sf)
    now = F.lit("2024-02-11").cast("timestamp")
    recent_rows = rollup.recent_cells(classify(rows))
    fresh = recent_rows.where(F.col("ingested") >= now - F.expr("interval 1 day")).select("file").distinct()
    minutes = tracks.underway(tracks.minutes(rows), with_file=True).join(fresh, "file", "left_semi").withColumnRenamed("h3_r8", "h3")
    return levels.last24_level(levels.recent_rows(recent_rows, now), minutes, 4)


@query(f"""WITH {LIVE_SQL}, {MINUTES_SQL}, {UNDERWAY_SQL}, first AS (SELECT {up('h3', 9, 8)} AS cell, min(coll_month) AS month FROM cells GROUP BY 1), n AS (SELECT month, count(*) AS k FROM first GROUP BY 1),
h AS (SELECT left(day, 7) AS month, round(CAST(sum(min_underway) AS DOUBLE) / 60.0 * 10) / 10 AS h FROM uw GROUP BY 1)
SELECT coalesce(n.month, h.month) AS month, coalesce(h.h, 0.0) AS underway_h, CAST(coalesce(n.k, 0) AS BIGINT) AS new_cells_r8 FROM n FULL JOIN h ON n.month = h.month""")
def first_seen_reach(spark, sf):
    cells, _, minutes = _live(spark, sf)
    return levels.reach_series(cells, minutes)


@query(f"""WITH {LIVE_SQL}, t AS (SELECT {up(up('h3', 9, 6), 6, 1)} AS p, count(*) AS rows, min({lon_of(up('h3', 9, 6), 6)}) AS w, min({lat_of(up('h3', 9, 6), 6)}) AS s, max({lon_of(up('h3', 9, 6), 6)}) AS e, max({lat_of(up('h3', 9, 6), 6)}) AS n FROM (SELECT DISTINCT {up('h3', 9, 6)} AS c6, min(h3) AS h3 FROM cells GROUP BY 1) GROUP BY 1)
SELECT 6 AS res, lower(printf('%X', p)) AS part, CAST(rows AS BIGINT) AS rows, round(greatest(-180.0, CASE WHEN e - w > 180 THEN -180.0 ELSE w END - 0.05) * 10000) / 10000 AS west, round(greatest(-90.0, s - 0.05) * 10000) / 10000 AS south,
round(least(180.0, CASE WHEN e - w > 180 THEN 180.0 ELSE e END + 0.05) * 10000) / 10000 AS east, round(least(90.0, n + 0.05) * 10000) / 10000 AS north FROM t""")
def tile_manifest(spark, sf):
    return levels.tiles(levels.cells_at(_live(spark, sf)[0], 6), 6)


VIEW = (-40.0, -20.0, 60.0, 45.0)


@query(f"""WITH {LIVE_SQL}, t AS (SELECT {up(up('h3', 9, 6), 6, 1)} AS p, min({lon_of(up('h3', 9, 6), 6)}) AS w, min({lat_of(up('h3', 9, 6), 6)}) AS s, max({lon_of(up('h3', 9, 6), 6)}) AS e, max({lat_of(up('h3', 9, 6), 6)}) AS n, count(DISTINCT {up('h3', 9, 6)}) AS rows FROM cells GROUP BY 1),
b AS (SELECT lower(printf('%X', p)) AS part, CAST(rows AS BIGINT) AS rows, CASE WHEN e - w > 180 THEN -180.0 ELSE w END - 0.05 AS w, s - 0.05 AS s, CASE WHEN e - w > 180 THEN 180.0 ELSE e END + 0.05 AS e, n + 0.05 AS n FROM t)
SELECT part, rows FROM b WHERE w <= {VIEW[2]} AND e >= {VIEW[0]} AND s <= {VIEW[3]} AND n >= {VIEW[1]}""")
def viewport_tiles(spark, sf):
    tiles = levels.tiles(levels.cells_at(_live(spark, sf)[0], 6), 6)
    return levels.viewport(tiles, levels.resolution_of(6), *VIEW).select("part", "rows")


@query(f"""WITH {READINGS}, p AS (SELECT event_id AS id, (lon_d + 180.0) / 360.0 AS x, (lat_d + 90.0) / 180.0 AS y FROM readings), c AS (SELECT DISTINCT {lattice(4)} AS cell FROM readings WHERE provider = 'view' OR event_id % 5 = 0),
k AS (SELECT cell, ({lon_of('cell', 4)} + 180.0) / 360.0 AS cx, ({lat_of('cell', 4)} + 90.0) / 180.0 AS cy FROM c), d AS (SELECT id, cell, (x - cx) * (x - cx) + (y - cy) * (y - cy) AS d2 FROM p JOIN k ON abs(x - cx) <= 0.005 AND abs(y - cy) <= 0.005)
SELECT id, arg_min(cell, (d2, cell)) AS cell, sqrt(min(d2)) AS distance FROM d WHERE d2 <= 0.005 * 0.005 GROUP BY id""")
def nearest_cell(spark, sf):
    rows = readings(spark, sf)
    x, y = (F.col("lon_d") + 180.0) / 360.0, (F.col("lat_d") + 90.0) / 180.0
    points = rows.select(F.col("event_id").alias("id"), x.alias("x"), y.alias("y"))
    cells = rows.where("provider = 'view' OR event_id % 5 = 0").select(grid.cell(F.col("lat_d"), F.col("lon_d"), 4).alias("cell")).distinct()
    centre = cells.select("cell", ((grid.center_lon(F.col("cell")) + 180.0) / 360.0).alias("x"), ((grid.center_lat(F.col("cell")) + 90.0) / 180.0).alias("y"))
    return levels.nearest(points, centre, 0.005)


# Selection and matching.


@query("""WITH listed AS (SELECT 'k' || CAST(o_custkey AS VARCHAR) AS key, 'e' || CAST(o_orderkey % 3 AS VARCHAR) AS etag, o_orderdate AS last_modified, o_orderkey AS size FROM orders),
i AS (SELECT DISTINCT key, etag FROM listed WHERE size % 4 = 0), n AS (SELECT l.*, row_number() OVER (PARTITION BY l.key ORDER BY last_modified DESC, l.etag, size) AS n FROM listed l ANTI JOIN i ON i.key = l.key AND i.etag = l.etag)
SELECT key, max(last_modified) AS last_modified FROM n WHERE n = 1 GROUP BY key""")
def new_objects(spark, sf):
    o = table(spark, sf, "orders")
    listed = o.select(F.concat(F.lit("k"), F.col("o_custkey").cast("string")).alias("key"), F.concat(F.lit("e"), (F.col("o_orderkey") % 3).cast("string")).alias("etag"), F.col("o_orderdate").alias("last_modified"), F.col("o_orderkey").alias("size"))
    return match.new_objects(listed, listed.where("size % 4 = 0").select("key", "etag").distinct()).select("key", "last_modified")


@query("""SELECT o_orderkey, size FROM (SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS size, row_number() OVER w AS n, sum(CAST(round(o_totalprice * 100) AS BIGINT)) OVER w AS s FROM orders WINDOW w AS (ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
WHERE n = 1 OR (n <= 400 AND s <= 3000000000)""")
def budgeted_prefix(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", F.round(F.col("o_totalprice") * 100).cast("long").alias("size"))
    return match.within_budget(o, ["o_orderdate", "o_orderkey"], "size", 400, 3_000_000_000).select("o_orderkey", "size")


@query(f"""WITH {CLASSIFIED}, {META_SQL}, c AS (SELECT file, unique_id, {TALLIES} FROM classified GROUP BY ALL), i AS (SELECT m.*, c.n_unique FROM meta m JOIN c USING (file, unique_id)), n AS (SELECT * FROM i WHERE file >= 'f35')
SELECT DISTINCT i.file, i.unique_id FROM i JOIN n ON i.provider = n.provider AND i.n_unique > 0 AND i.t_min <= n.t_max AND i.t_max >= n.t_min AND i.lon_min <= n.lon_max AND i.lon_max >= n.lon_min AND i.lat_min <= n.lat_max AND i.lat_max >= n.lat_min WHERE i.file < 'f35'""")
def candidate_overlap(spark, sf):
    rows = readings(spark, sf)
    index = rollup.group_meta(rows).join(rollup.file_counts(classify(rows)).drop("n_rows"), ["file", "unique_id"]).withColumns({"status": F.lit("live"), "key": F.col("file")}).drop("fingerprint")
    return match.overlapping(index.where("file >= 'f35'"), index.where("file < 'f35'")).select("file", "unique_id").distinct()


@query(f"WITH {CLASSIFIED} SELECT file, unique_id, {TALLIES} FROM classified WHERE file >= 'f20' GROUP BY ALL")
def incremental_equals_full(spark, sf):
    """The second half of the files, classified as an incremental run does, against a full census."""
    rows = readings(spark, sf)
    old, new = rows.where("file < 'f20'"), rows.where("file >= 'f20'")
    groups = rollup.group_meta(new)
    none = groups.limit(0).select("file", "unique_id", F.col("file").alias("dup_of"), F.col("unique_id").alias("dup_uid"))
    return rollup.file_counts(incremental.classify_new(new, groups, none, old))


@query(f"WITH {CLASSIFIED} SELECT provider, coll_month, {lattice(9)} AS h3_r9, -CAST(count(*) AS BIGINT) AS n_rows, -CAST(count(*) FILTER (WHERE class = 'unique') AS BIGINT) AS n_unique, -CAST(count(*) FILTER (WHERE class = 'dup_resend') AS BIGINT) AS n_dup_resend, -CAST(count(*) FILTER (WHERE class = 'dup_cross_id') AS BIGINT) AS n_dup_cross_id FROM classified WHERE CAST(right(file, 2) AS INTEGER) % 4 = 1 GROUP BY ALL")
def reconcile_deltas(spark, sf):
    classified = classify(readings(spark, sf))
    index = rollup.file_counts(classified).withColumns({"status": F.lit("live"), "key": F.col("file"), "etag": F.lit("e"), "provider": F.lit(None).cast("string")})
    listed = index.where("cast(right(file, 2) as int) % 4 <> 1").select("key", "etag").distinct()
    return reconcile.retract_cells(rollup.recent_cells(classified), reconcile.gone_groups(index, listed))


@query(f"WITH {CLASSIFIED} SELECT provider, coll_month, {lattice(9)} AS h3, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(*) FILTER (WHERE class = 'unique') AS BIGINT) AS n_unique FROM classified WHERE CAST(right(file, 2) AS INTEGER) % 4 <> 1 AND {lattice(9)} IS NOT NULL GROUP BY ALL")
def base_plus_delta(spark, sf):
    """Cells of all files, less the deltas of files that went: the cells of the others."""
    classified = classify(readings(spark, sf))
    gone = rollup.file_counts(classified).where("cast(right(file, 2) as int) % 4 = 1")
    delta = reconcile.retract_cells(rollup.recent_cells(classified), gone).withColumn("run_id", F.lit("r"))
    return rollup.live_cells(rollup.base_plus_delta(rollup.month_cells(classified), delta))


# Tracks.


@query(f"WITH {READINGS}, {MINUTES_SQL} SELECT file, platform, provider, {sql_ts('m', 'm')}, n, round(lon * 1e6) / 1e6 AS lon, round(lat * 1e6) / 1e6 AS lat FROM banded")
def minutes(spark, sf):
    return tracks.minutes(readings(spark, sf)).select("file", "platform", "provider", ts("m"), "n", scalars.round_at(F.col("lon"), 6).alias("lon"), scalars.round_at(F.col("lat"), 6).alias("lat"))


@query(f"WITH {READINGS}, {MINUTES_SQL} SELECT band, CAST(count(*) AS BIGINT) AS minutes, CAST(sum(n) AS BIGINT) AS soundings FROM banded GROUP BY ALL")
def speed_bands(spark, sf):
    return tracks.minutes(readings(spark, sf)).groupBy("band").agg(F.count("*").alias("minutes"), F.sum("n").cast("long").alias("soundings"))


@query(f"WITH {READINGS}, {MINUTES_SQL}, {UNDERWAY_SQL} SELECT * FROM uw")
def underway_rollup(spark, sf):
    return tracks.underway(tracks.minutes(readings(spark, sf)))


@query(f"""WITH {READINGS}, {MINUTES_SQL}, {UNDERWAY_SQL}, d AS (SELECT platform, day, sum(min_underway) AS u, sum(min_stationary) AS s FROM uw GROUP BY ALL)
SELECT CAST(round(CAST(sum(u) AS DOUBLE) / 60.0) AS BIGINT) AS underway_hours, CAST(round(CAST(sum(s) AS DOUBLE) / 60.0) AS BIGINT) AS stationary_hours, CAST(count(*) AS BIGINT) AS platform_days_logged, CAST(count(*) FILTER (WHERE u = 0) AS BIGINT) AS platform_days_never_underway,
round(CAST(count(*) FILTER (WHERE u = 0) AS DOUBLE) / count(*) * 10000) / 10000 AS share_never_underway FROM d""")
def platform_day_share(spark, sf):
    return recent.platform_days(tracks.underway(tracks.minutes(readings(spark, sf))))


# Regions.

BOX = (-60.0, -40.0, 75.0, 50.0)
POLYGON = [[[[BOX[0], BOX[1]], [BOX[2], BOX[1]], [BOX[2], BOX[3]], [BOX[0], BOX[3]], [BOX[0], BOX[1]]]]]
IN_BOX = "{lon} >= -60.0 AND {lon} < 75.0 AND {lat} >= -40.0 AND {lat} < 50.0"


def in_box(res: int, cell: str = "h3") -> str:
    return IN_BOX.format(lon=f"({lon_of(cell, res)})", lat=f"({lat_of(cell, res)})")


@query(f"SELECT CAST({4} * power(2, 56) AS BIGINT) + x * 268435456 + y AS h3 FROM range(4096) a(x), range(2048) b(y) WHERE (x + 0.5) * 360.0 / 4096 - 180.0 >= -60.0 AND (x + 0.5) * 360.0 / 4096 - 180.0 < 75.0 AND (y + 0.5) * 180.0 / 2048 - 90.0 >= -40.0 AND (y + 0.5) * 180.0 / 2048 - 90.0 < 50.0")
def region_cells(spark, sf):
    return region.Region(spark, POLYGON, 4).cells()


def area_of(cell: str, res: int) -> str:
    """Square kilometres of a lattice cell on the sphere."""
    y, ny, nx = f"(({cell}) % 268435456)", 1 << (res + grid.Y_BITS), 1 << (res + grid.X_BITS)
    edge = lambda k: f"sin(radians(({y} + {k}) * 180.0 / {ny} - 90.0))"
    return f"{grid.EARTH_KM**2!r} * (2 * pi() / {nx}) * ({edge(1)} - {edge(0)})"


LEVEL4 = f"c4 AS (SELECT provider, coll_month, {up('h3', 9, 4)} AS h3, CAST(sum(n_rows) AS BIGINT) AS n_rows, CAST(sum(n_unique) AS BIGINT) AS n_unique FROM cells GROUP BY ALL)"


@query(f"""WITH {LIVE_SQL}, {LEVEL4}, rc AS (SELECT * FROM c4 WHERE {in_box(4)}), e AS (SELECT h3, sum(n_unique) AS u, sum(n_rows) AS p FROM rc GROUP BY 1)
SELECT 'all' AS year, CAST(sum(u) AS BIGINT) AS "unique", CAST(sum(p) AS BIGINT) AS published, CAST(count(*) FILTER (WHERE u >= 1) AS BIGINT) AS cells_ge1, CAST(count(*) FILTER (WHERE u >= 100) AS BIGINT) AS cells_ge100,
(SELECT count(DISTINCT provider) FROM rc) AS providers, round(count(*) FILTER (WHERE u >= 1) / 1572864.0 * 10000) / 10000 AS share_ge1, round(count(*) FILTER (WHERE u >= 100) / 1572864.0 * 10000) / 10000 AS share_ge100,
round(sum(CASE WHEN u >= 1 THEN {area_of('h3', 4)} END) * 100) / 100 AS km2_covered FROM e""")
def region_coverage(spark, sf):
    cells = _live(spark, sf)[0].withColumn("h3", grid.parent(F.col("h3"), 4)).groupBy("provider", "coll_month", "h3").agg(F.sum("n_rows").alias("n_rows"), F.sum("n_unique").alias("n_unique"))
    shape = region.Region(spark, POLYGON, 4)
    return region.coverage(shape.within(cells), shape.area().first()["region_cells"])


@query(f"""WITH {READINGS}, r AS (SELECT *, {lattice(5)} AS h3 FROM readings), f AS (SELECT * FROM r WHERE {in_box(5)}), n AS (SELECT *, count(*) OVER (PARTITION BY key) AS n_copies, row_number() OVER (PARTITION BY key ORDER BY ingested, file, unique_id, provider) AS rn FROM f)
SELECT key, provider, unique_id, n_copies, file AS first_file FROM n WHERE rn = 1""")
def region_extract(spark, sf):
    return region.extract(region.Region(spark, POLYGON, 5).inside(readings(spark, sf)), 5).select("key", "provider", "unique_id", "n_copies", "first_file")


# Recent activity.

INDEX_SQL = f"{CLASSIFIED}, {META_SQL}, c AS (SELECT file, unique_id, {TALLIES} FROM classified GROUP BY ALL), i AS (SELECT m.*, c.n_unique FROM meta m JOIN c USING (file, unique_id)), pub AS (SELECT *, greatest(0.0, date_diff('second', CAST(left(t_max, 19) AS TIMESTAMP), ingested) / 3600.0) AS lag_h, min(ingested) OVER (PARTITION BY unique_id) AS first_seen FROM i)"


def _published(spark, sf):
    rows = readings(spark, sf)
    return recent.published(rollup.group_meta(rows).join(rollup.file_counts(classify(rows)).drop("n_rows"), ["file", "unique_id"]).withColumn("status", F.lit("live")))


def _strip_sql(name: str, days: int | None) -> str:
    where = f"WHERE ingested >= {NOW_SQL} - to_days({days})" if days else ""
    return f"""SELECT '{name}' AS "window", CAST(count(DISTINCT file) AS BIGINT) AS files, CAST(sum(n_rows) AS BIGINT) AS published, CAST(sum(n_unique) AS BIGINT) AS "unique", CAST(count(DISTINCT unique_id) AS BIGINT) AS platforms,
CAST(count(DISTINCT unique_id) FILTER (WHERE first_seen = ingested) AS BIGINT) AS new_platforms, CAST(count(DISTINCT provider) AS BIGINT) AS providers, round(median(CAST(lag_h AS DOUBLE)) * 10) / 10 AS median_lag_h FROM pub {where} HAVING count(*) > 0"""


@query(f"WITH {INDEX_SQL} " + " UNION ALL ".join(_strip_sql(*x) for x in recent.STRIP.items()))
def pub_strip(spark, sf):
    return recent.strip(_published(spark, sf), NOW)


@query(f"WITH {INDEX_SQL} SELECT {sql_ts('time_bucket(INTERVAL 6 HOUR, ingested)', 'batch')}, CAST(count(DISTINCT file) AS BIGINT) AS files, CAST(sum(n_rows) AS BIGINT) AS published, CAST(sum(n_unique) AS BIGINT) AS \"unique\" FROM pub WHERE ingested >= {NOW_SQL} - to_days(30) GROUP BY 1")
def batches_6h(spark, sf):
    return recent.batches(recent.since(_published(spark, sf), NOW, 30)).withColumn("batch", ts("batch"))


@query(f"WITH {INDEX_SQL} SELECT strftime(ingested, '%Y-%m-%d') AS day, CAST(count(DISTINCT file) AS BIGINT) AS files, CAST(sum(n_rows) AS BIGINT) AS published, CAST(sum(n_unique) AS BIGINT) AS \"unique\", CAST(count(DISTINCT unique_id) AS BIGINT) AS platforms FROM pub GROUP BY 1")
def daily_series(spark, sf):
    return recent.daily_published(_published(spark, sf))


@query(f"WITH {LIVE_SQL} SELECT day, CAST(sum(n_rows) AS BIGINT) AS published, CAST(sum(n_unique) AS BIGINT) AS \"unique\", CAST(count(DISTINCT platform) AS BIGINT) AS platforms, CAST(count(*) AS BIGINT) AS vessel_cells FROM live_vd GROUP BY 1")
def daily_collected(spark, sf):
    return recent.daily_collected(_live(spark, sf)[1])


LAG_CASE = "CASE " + " ".join(f"WHEN lag_h < {m} THEN '{n}'" for n, m in recent.LAGS.items() if m) + " ELSE '>1y' END"


@query(f"WITH {INDEX_SQL}, b AS (SELECT {LAG_CASE} AS bucket, count(*) AS n FROM pub GROUP BY 1), names AS (SELECT * FROM (VALUES {', '.join(f'({i}, {n!r})' for i, n in enumerate(recent.LAGS))}) v(place, bucket)) SELECT place, bucket, CAST(coalesce(n, 0) AS BIGINT) AS n FROM names LEFT JOIN b USING (bucket)")
def lag_histogram(spark, sf):
    return recent.histogram(_published(spark, sf), "lag_h", recent.LAGS)


RUNS_SQL = "runs AS (SELECT CAST(o_orderkey AS VARCHAR) AS run_id, CASE WHEN o_orderkey % 5 = 0 THEN 'reconcile' ELSE 'incremental' END AS kind, o_orderkey % 7 AS new_files, o_orderdate AS newest_published, o_orderdate + to_seconds(o_custkey * 97 % 40000) AS finished_at, o_orderdate AS run_at FROM orders)"


def _runs(spark, sf):
    o = table(spark, sf, "orders")
    done = F.timestamp_seconds(F.unix_seconds(F.col("o_orderdate").cast("timestamp")) + F.col("o_custkey") * 97 % 40000)
    return o.select(F.col("o_orderkey").cast("string").alias("run_id"), F.when(F.col("o_orderkey") % 5 == 0, "reconcile").otherwise("incremental").alias("kind"), (F.col("o_orderkey") % 7).alias("new_files"), F.col("o_orderdate").cast("timestamp").alias("newest_published"), done.alias("finished_at"), F.col("o_orderdate").cast("timestamp").alias("run_at"))


@query(f"""WITH {RUNS_SQL}, r AS (SELECT newest_published, finished_at, date_diff('second', newest_published, finished_at) / 60.0 AS lat FROM runs WHERE kind = 'incremental' AND new_files > 0)
SELECT CAST((SELECT round(lat) FROM r ORDER BY finished_at DESC, newest_published DESC LIMIT 1) AS BIGINT) AS last_latency_min, (SELECT {sql_ts('newest_published', 'x').removesuffix(' AS x')} FROM r ORDER BY finished_at DESC, newest_published DESC LIMIT 1) AS last_batch_published,
CAST((SELECT round(median(CAST(lat AS DOUBLE))) FROM r WHERE finished_at >= TIMESTAMP '1998-06-01' - to_days(30)) AS BIGINT) AS median_latency_min_30d""")
def latency_median(spark, sf):
    got = recent.latency(_runs(spark, sf), datetime(1998, 6, 1))
    return got.select("last_latency_min", ts("last_batch_published"), "median_latency_min_30d")


@query(f"WITH {RUNS_SQL} SELECT run_id, {sql_ts('run_at', 'run_at')} FROM runs ORDER BY runs.run_at DESC, run_id LIMIT 120")
def runs_top(spark, sf):
    return recent.newest_runs(_runs(spark, sf)).select("run_id", ts("run_at"))


@query(f"WITH {INDEX_SQL}, m AS (SELECT file, unique_id, coll_month, {TALLIES} FROM classified GROUP BY ALL) SELECT coll_month AS month, i.provider, CAST(sum(m.n_rows) AS BIGINT) AS published, CAST(sum(m.n_unique) AS BIGINT) AS \"unique\", CAST(sum(m.n_dup_resend) AS BIGINT) AS dup_resend, CAST(sum(m.n_dup_cross_id) AS BIGINT) AS dup_cross_id FROM m JOIN i USING (file, unique_id) GROUP BY ALL")
def month_series(spark, sf):
    rows = readings(spark, sf)
    return recent.month_series(rollup.file_month_counts(classify(rows)), rollup.group_meta(rows).withColumn("status", F.lit("live")), by_provider=True)


@query(f"WITH {INDEX_SQL}, c2 AS (SELECT file, unique_id, n_dup_resend, n_dup_cross_id FROM c) SELECT CAST(sum(n_rows) AS BIGINT) AS published, CAST(sum(n_unique) AS BIGINT) AS \"unique\", CAST(sum(n_dup_resend) AS BIGINT) AS dup_resend, CAST(sum(n_dup_cross_id) AS BIGINT) AS dup_cross_id, CAST(count(DISTINCT file) AS BIGINT) AS files, CAST(count(DISTINCT provider) AS BIGINT) AS providers, CAST(count(DISTINCT unique_id) AS BIGINT) AS platforms, {sql_ts('max(ingested)', 'last_ingested')} FROM i JOIN c2 USING (file, unique_id)")
def totals(spark, sf):
    rows = readings(spark, sf)
    index = rollup.group_meta(rows).join(rollup.file_counts(classify(rows)).drop("n_rows"), ["file", "unique_id"]).withColumn("status", F.lit("live"))
    return recent.totals(index).withColumn("last_ingested", ts("last_ingested"))


@query("""WITH d AS (SELECT event_type, strftime(ts, '%Y-%m-%d') AS day, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY ALL) SELECT event_type, day, n, avg(n) OVER (PARTITION BY event_type ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS mean FROM d""")
def moving_average_7(spark, sf):
    d = table(spark, sf, "events").groupBy("event_type", scalars.day_text(F.col("ts")).alias("day")).agg(F.count("*").alias("n"))
    return levels.trailing_mean(d, ["event_type"], "day", "n", 7)


@query("""WITH t AS (SELECT event_id, CASE event_id % 6 WHEN 0 THEN CAST(value AS VARCHAR) WHEN 1 THEN '1.5e2' WHEN 2 THEN 'deep' WHEN 3 THEN '' WHEN 4 THEN '12x' END AS number,
  CASE event_id % 5 WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') WHEN 1 THEN 'no-time' WHEN 2 THEN '2024-02-30T00:00:00Z' WHEN 3 THEN left(strftime(ts, '%Y-%m-%dT%H:%M:%SZ'), 10) END AS time,
  CASE event_id % 3 WHEN 0 THEN strftime(ts, '%Y%m%d%H%M%S') || '000000_a.csv' WHEN 1 THEN 'notastamp' END AS file, event_type || ' & Co., No. ' || CAST(user_id % 7 AS VARCHAR) AS name FROM events)
SELECT event_id, TRY_CAST(CASE WHEN regexp_full_match(number, '[-+]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][-+]?[0-9]+)?') THEN number END AS DOUBLE) AS number, strftime(TRY_STRPTIME(left(time, 19), '%Y-%m-%dT%H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS at, CAST(TRY_CAST(left(time, 10) AS DATE) AS VARCHAR) AS day,
  CASE WHEN regexp_matches(coalesce(time, ''), '^[0-9]{4}-[0-9]{2}') THEN left(time, 7) ELSE 'invalid' END AS month, strftime(TRY_STRPTIME(left(file, 14), '%Y%m%d%H%M%S'), '%Y-%m-%d %H:%M:%S') AS stamp, trim(regexp_replace(lower(name), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM t""")
def lenient_parsing(spark, sf):
    e, n = table(spark, sf, "events"), F.col("event_id")
    time = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    t = e.select(
        n, F.when(n % 6 == 0, F.col("value").cast("string")).when(n % 6 == 1, "1.5e2").when(n % 6 == 2, "deep").when(n % 6 == 3, "").when(n % 6 == 4, "12x").alias("number"),
        F.when(n % 5 == 0, time).when(n % 5 == 1, "no-time").when(n % 5 == 2, "2024-02-30T00:00:00Z").when(n % 5 == 3, F.left(time, F.lit(10))).alias("time"),
        F.when(n % 3 == 0, F.concat(F.date_format("ts", "yyyyMMddHHmmss"), F.lit("000000_a.csv"))).when(n % 3 == 1, "notastamp").alias("file"), F.concat("event_type", F.lit(" & Co., No. "), (F.col("user_id") % 7).cast("string")).alias("name"),
    )
    c, text = F.col, lambda x: F.date_format(x, "yyyy-MM-dd HH:mm:ss")
    return t.select(n, scalars.safe_double(c("number")).alias("number"), text(scalars.parse_time(c("time"))).alias("at"), F.left("time", F.lit(10)).try_cast("date").cast("string").alias("day"), scalars.month_of(F.coalesce("time", F.lit(""))).alias("month"), text(scalars.parse_stamp(c("file"))).alias("stamp"), scalars.slug_column(c("name")).alias("slug"))


@query("""WITH r AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS j FROM events)
SELECT user_id, event_type, CAST(min(i) AS BIGINT) AS first, CAST(count(*) AS BIGINT) AS length FROM r GROUP BY user_id, event_type, i - j""")
def run_length(spark, sf):
    return levels.run_lengths(table(spark, sf, "events").select("user_id", "event_type", "event_id"), ["user_id"], "event_id", "event_type")


@query("""SELECT c_mktsegment, CAST(count(*) FILTER (WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)) AS BIGINT) AS with_orders, CAST(count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)) AS BIGINT) AS without_orders,
CAST(count(*) FILTER (WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')) AS BIGINT) AS with_finished FROM customer GROUP BY 1""")
def semi_anti_exists(spark, sf):
    c, o = table(spark, sf, "customer"), table(spark, sf, "orders")
    per = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.bool_or(F.col("o_orderstatus") == "F").alias("finished"))
    joined = c.join(per, "c_custkey", "left")
    return joined.groupBy("c_mktsegment").agg(F.count_if(F.col("finished").isNotNull()).alias("with_orders"), F.count_if(F.col("finished").isNull()).alias("without_orders"), F.count_if(F.col("finished")).alias("with_finished"))


@query(f"WITH {LIVE_SQL} SELECT left(coll_month, 4) AS year, {SUMS.replace('n_dup_resend) AS BIGINT) AS n_dup_resend', 'n_rows - n_unique) AS BIGINT) AS n_dup').split(', CAST(sum(n_dup_cross_id)')[0]} FROM cells GROUP BY 1")
def year_rollup(spark, sf):
    cells = _live(spark, sf)[0]
    return cells.groupBy(F.left("coll_month", F.lit(4)).alias("year")).agg(F.sum("n_rows").alias("n_rows"), F.sum("n_unique").alias("n_unique"), F.sum(F.col("n_rows") - F.col("n_unique")).alias("n_dup"))


# Whole runs over an archive made of the view's readings, and streams.


@contextmanager
def _folder(spark: SparkSession, name: str) -> Iterator[str]:
    """A folder that driver and executors share, for as long as a query works in it."""
    context = spark.sparkContext
    top = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        top = tempfile.gettempdir()
    path = f"{top}/{name}-{uuid.uuid4().hex}"
    try:
        yield path
    finally:
        Files(spark).remove(path)


def _result(df: DataFrame) -> DataFrame:
    """A small result that does not need the folder it was made in any more."""
    df = df.persist()
    rows = df.collect()  # a row for each file, provider or month of the view
    df.unpersist()
    return df.sparkSession.createDataFrame(rows, df.schema)


def _archive(spark: SparkSession, rows: DataFrame) -> Tables:
    """Readings as an archive: files are published in order, some seconds after their stamp, under the day of the stamp."""
    text = rows.withColumns({"file": F.concat(F.date_format("ingested", "yyyyMMddHHmmss"), F.lit("-"), "file"), "lon": F.col("lon_d").cast("string"), "lat": F.col("lat_d").cast("string"), "depth": F.col("key")})
    published = text.select("file", F.col("unique_id").alias("UNIQUE_ID"), F.col("provider").alias("PROVIDER"), F.col("lon").alias("LON"), F.col("lat").alias("LAT"), F.col("depth").alias("DEPTH"), F.col("time").alias("TIME"))
    listed = text.groupBy("file", "ingested").agg(F.count("*").alias("size")).select(
        F.concat(F.lit("a/"), F.date_format("ingested", "yyyy/MM/dd"), F.lit("/"), "file").alias("key"), F.col("file").alias("name"), "size", F.lit("e").alias("etag"), (F.col("ingested") + F.expr("interval 30 seconds")).alias("last_modified")
    )
    return Tables(listed, published)


# The archive's identity: position, day's bin and time as published; `depth` carries the view's own key.
RUN_READINGS = f"""{READINGS}, pub AS (SELECT strftime(ingested, '%Y%m%d%H%M%S') || '-' || file AS file, unique_id, provider, time, coll_month, ingested, lon_d, lat_d,
  md5(concat_ws('|', CAST(lon_d AS VARCHAR), CAST(lat_d AS VARCHAR), key, time)) AS key FROM readings)"""
AGAIN_DAYS = 12


def _twice(rows: DataFrame) -> DataFrame:
    """The readings, and all of each file once more, some days later."""
    later = rows.withColumn("ingested", F.col("ingested") + F.expr(f"interval {AGAIN_DAYS} days"))
    return rows.unionByName(later)


RUN_CLASSES = f"""{RUN_READINGS}, both_times AS (SELECT * FROM pub UNION ALL SELECT strftime(ingested + to_days({AGAIN_DAYS}), '%Y%m%d%H%M%S') || '-' || right(file, 3) AS file, unique_id, provider, time, coll_month, ingested + to_days({AGAIN_DAYS}) AS ingested, lon_d, lat_d, key FROM pub),
classified AS (SELECT *, CASE WHEN row_number() OVER w = 1 THEN 'unique' WHEN first_value(unique_id) OVER w = unique_id THEN 'dup_resend' ELSE 'dup_cross_id' END AS class
  FROM both_times WINDOW w AS (PARTITION BY key ORDER BY ingested, file, unique_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""
RUN_NOW = datetime(2024, 2, 25, tzinfo=UTC)


@contextmanager
def _grown(spark: SparkSession, sf: str) -> Iterator[tuple[Ledger, Tables]]:
    """A ledger seeded with the first files and brought up to date by two runs."""
    cutoff = datetime(2024, 2, 6, tzinfo=UTC)
    with _folder(spark, "fathomline-run") as where, Work(spark, where) as work:
        made = _archive(spark, _twice(readings(spark, sf)))
        archive = Tables(work.keep(made.listed), work.keep(made.rows))
        early = AsOf(archive, cutoff)
        census.stage(spark, keyed(archive.published(spark, early.listing(spark))), f"{where}/census", "early")
        census.rank(spark, f"{where}/census")
        census.finalize(spark, f"{where}/census")
        ledger = Ledger(spark, f"{where}/ledger")
        seed.seed(spark, f"{where}/census", ledger, early, now=cutoff)
        for now in (datetime(2024, 2, 12, tzinfo=UTC), RUN_NOW):
            incremental.run(spark, ledger, AsOf(archive, now), now, f"run-{now:%m%d}")
        yield ledger, archive


@query(f"WITH {RUN_CLASSES} SELECT file, unique_id, min(provider) AS provider, 'live' AS status, {TALLIES} FROM classified GROUP BY file, unique_id")
def incremental_run(spark, sf):
    """Census, seed, two runs; the second finds whole files again by their fingerprints."""
    with _grown(spark, sf) as (ledger, _):
        return _result(ledger.read("file_index").select("file", "unique_id", "provider", "status", "n_rows", "n_unique", "n_dup_resend", "n_dup_cross_id"))


@query(f"""WITH {RUN_CLASSES}, n AS (SELECT coll_month, provider, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(*) FILTER (WHERE class = 'unique') AS BIGINT) AS n_unique FROM classified WHERE {lattice(9)} IS NOT NULL GROUP BY ALL),
v AS (SELECT provider, platform, day, count(*) AS cells FROM (SELECT provider, unique_id AS platform, left(time, 10) AS day, {lattice(8)} AS h3 FROM classified WHERE {lattice(8)} IS NOT NULL GROUP BY ALL HAVING count(*) FILTER (WHERE class <> 'dup_cross_id') > 0) GROUP BY ALL)
SELECT n.*, (SELECT CAST(sum(cells) AS BIGINT) FROM v WHERE v.provider = n.provider AND left(day, 7) = n.coll_month) AS vessel_day_cells FROM n""")
def live_after_runs(spark, sf):
    """Base and deltas of cells and vessel-days, as the ledger has them after the runs."""
    with _grown(spark, sf) as (ledger, _):
        cells = rollup.live_cells(rollup.base_plus_delta(ledger.read("cells_base"), ledger.read("cells_delta")))
        vdays = rollup.live_vessel_days(rollup.base_plus_delta(ledger.read("vdays_base"), ledger.read("vdays_delta")))
        a = cells.groupBy("coll_month", "provider").agg(F.sum("n_rows").alias("n_rows"), F.sum("n_unique").alias("n_unique"))
        b = vdays.groupBy(F.left("day", F.lit(7)).alias("coll_month"), "provider").agg(F.count("*").alias("vessel_day_cells"))
        return _result(a.join(b, ["coll_month", "provider"], "left"))


GONE = "CAST(right(file, 2) AS INTEGER) % 4 = 1"


@query(f"""WITH {RUN_CLASSES}, f AS (SELECT * FROM classified WHERE strptime(left(file, 14), '%Y%m%d%H%M%S') >= TIMESTAMP '2024-02-06' AND {GONE}),
vd AS (SELECT provider, unique_id AS platform, left(time, 10) AS day, {lattice(8)} AS h3_r8, {TALLIES} FROM f WHERE {lattice(8)} IS NOT NULL GROUP BY ALL)
SELECT provider, platform, CAST(count(*) AS BIGINT) AS keys, -CAST(sum(n_rows) AS BIGINT) AS n_rows, -CAST(sum(n_unique) AS BIGINT) AS n_unique, -CAST(sum(n_dup_resend) AS BIGINT) AS n_dup_resend, -CAST(sum(n_dup_cross_id) AS BIGINT) AS n_dup_cross_id FROM vd GROUP BY ALL""")
def reconcile_vessel_days(spark, sf):
    """Files vanish from the listing; what reconciliation takes back from the vessel-days of files that runs brought."""
    with _grown(spark, sf) as (ledger, archive):
        left = Tables(archive.listed.where("cast(right(key, 2) as int) % 4 <> 1"), archive.rows)
        reconcile.reconcile(spark, ledger, left, RUN_NOW)
        taken = ledger.read("vdays_delta").where(F.col("run_id").startswith("reconcile"))
        return _result(taken.groupBy("provider", "platform").agg(F.count("*").alias("keys"), *summed()))


@query(f"""WITH {RUN_CLASSES}, g AS (SELECT file, unique_id, min(provider) AS provider FROM classified WHERE {GONE} GROUP BY ALL HAVING count(*) FILTER (WHERE class = 'unique') > 0)
SELECT DISTINCT g.provider, c.coll_month, 'removed original' AS reason FROM g JOIN classified c USING (file, unique_id)""")
def reconcile_queue(spark, sf):
    """Months to be counted again after originals vanished."""
    with _grown(spark, sf) as (ledger, archive):
        left = Tables(archive.listed.where("cast(right(key, 2) as int) % 4 <> 1"), archive.rows)
        reconcile.reconcile(spark, ledger, left, RUN_NOW)
        return _result(ledger.read("queue").where("reason = 'removed original'").select("provider", "coll_month", "reason").distinct())


@query(f"WITH {CLASSIFIED} SELECT provider, coll_month, {TALLIES} FROM classified GROUP BY ALL")
def state_roundtrip(spark, sf):
    """A table committed to a ledger, checked, mirrored and read back from the mirror."""
    with _folder(spark, "fathomline-ledger") as where:
        here, there = Ledger(spark, f"{where}/here"), Ledger(spark, f"{where}/there")
        here.commit({"cells_base": rollup.month_cells(classify(readings(spark, sf)))})
        push(here, there, found=True)
        there.check(deep=True)
        return _result(Ledger(spark, there.root).read("cells_base").groupBy("provider", "coll_month").agg(*summed()))


@query(f"WITH {READINGS}, o AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY (event_id % 40) // 8, ingested, file, unique_id, event_id) AS n, first_value(unique_id) OVER (PARTITION BY key ORDER BY (event_id % 40) // 8, ingested, file, unique_id, event_id) AS u FROM readings), classified AS (SELECT *, CASE WHEN n = 1 THEN 'unique' WHEN u = unique_id THEN 'dup_resend' ELSE 'dup_cross_id' END AS class FROM o) SELECT provider, {TALLIES} FROM classified GROUP BY ALL")
def stream_classify(spark, sf):
    """A stream of five micro-batches; equal to a full census, as batches come in order of ingest."""
    with _folder(spark, "fathomline-stream") as where:
        rows = readings(spark, sf).drop("event_id")
        for n in range(5):  # a file of the stream's source for each batch, in order of their times
            batch = rows.where(F.floor(F.substring("file", 2, 2).cast("int") / 8) == n)
            batch.coalesce(1).write.mode("append").parquet(f"{where}/source")
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{where}/source")
        ingest.start(stream, f"{where}/out", f"{where}/progress").awaitTermination()
        return _result(spark.read.parquet(f"{where}/out/classified").groupBy("provider").agg(*tallies()))


@query(f"WITH {READINGS} SELECT {sql_ts('time_bucket(INTERVAL 6 HOUR, ingested)', 'start')}, provider, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT unique_id) AS INTEGER) AS platforms FROM readings GROUP BY ALL")
def stream_windows(spark, sf):
    """The streaming form of the 6-hour batches, with exact platforms."""
    name = f"windows_{uuid.uuid4().hex}"
    with _folder(spark, "fathomline-windows") as where:
        rows = readings(spark, sf).select("ingested", "provider", "unique_id")
        rows.write.parquet(f"{where}/source")
        stream = ingest.windowed(spark.readStream.schema(rows.schema).parquet(f"{where}/source"))
        stream.writeStream.format("memory").queryName(name).outputMode("complete").option("checkpointLocation", f"{where}/progress").trigger(availableNow=True).start().awaitTermination()
        out = _result(spark.table(name).select(F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("start"), "provider", "n_rows", "platforms"))
        spark.catalog.dropTempView(name)
        return out
