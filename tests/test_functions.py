from __future__ import annotations

import http.client
import math
import urllib.parse
from datetime import date, datetime

import duckdb
import pytest
from observations import WHOLE, publish
from pyspark.sql import functions as F

from fathomline.functions import grid, identity, projection, scalars
from fathomline.functions.schema import PUBLISHED, STATE, conform, struct
from fathomline.operators import levels, match, recent, region, tracks
from fathomline.operators.classify import classify, classify_by_window
from fathomline.plans import queries
from fathomline.sources import archives
from fathomline.streaming import ingest


def one(spark, expression, **values):
    names = list(values) or ["x"]
    return spark.createDataFrame([tuple(values.values()) or (1,)], ", ".join(f"{n} {'string' if isinstance(values.get(n), str) or values.get(n) is None else 'double'}" for n in names)).select(expression).first()[0]


def test_low_half_is_duckdbs(spark):
    for text in ("a|b|c|d", "", "x|||y"):
        want = duckdb.connect().execute("SELECT md5_number_lower(?)", [text]).fetchone()[0]
        assert int(one(spark, identity.low64(F.md5("x")), x=text)) == want
    assert one(spark, identity.joined(F.lit("a"), F.lit(None), F.lit("c"))) == "a||c"


def test_fingerprint_wraps(spark):
    rows = spark.createDataFrame([(f"{i}",) for i in range(50)], "x string").select(F.md5("x").alias("key"))
    got = rows.agg(identity.fingerprint(F.col("key"))).first()[0]
    want = sum(duckdb.connect().execute("SELECT md5_number_lower(?)", [str(i)]).fetchone()[0] for i in range(50)) % 2**64
    assert int(got) == want


@pytest.mark.parametrize(("text", "want"), [("1.5", 1.5), ("-.5e1", -5.0), ("1.0d", None), ("1f", None), ("1_000", None), ("", None), (None, None), ("NaN", None)])
def test_safe_double(spark, text, want):
    assert one(spark, scalars.safe_double(F.col("x").cast("string")), x=text) == want


def test_times(spark):
    assert one(spark, scalars.parse_time(F.col("x")), x="2026-8-3T1:2:3") == datetime(2026, 8, 3, 1, 2, 3)
    assert one(spark, scalars.parse_time(F.col("x")), x="2026-02-30T00:00:00Z") is None
    assert one(spark, scalars.parse_stamp(F.col("x")), x="20260901020304000000_x.csv") == datetime(2026, 9, 1, 2, 3, 4)
    assert one(spark, scalars.parse_stamp(F.col("x")), x="notastamp") is None
    assert one(spark, scalars.month_of(F.col("x")), x="2026-13-01") == "2026-13" and one(spark, scalars.month_of(F.col("x")), x="x") == "invalid"
    t = lambda s: F.lit(s).cast("timestamp")
    assert one(spark, scalars.boundaries("minute", t("2026-01-01 00:00:59"), t("2026-01-01 00:01:01"))) == 1
    assert one(spark, scalars.round_at(F.lit(1.005), 2)) == 1.0
    assert scalars.slug("ABC Co., Ltd.") == one(spark, scalars.slug_column(F.lit("ABC Co., Ltd."))) == "abc-co-ltd" and scalars.slug("--") == "unknown"


def test_knots(spark):
    got = one(spark, scalars.knots(F.lit(41.0), F.lit(-72.0), F.lit(41.003), F.lit(-72.0), F.lit(60.0)))
    assert got == pytest.approx(math.radians(0.003) * 6_371_000 / 60 * 1.943844, rel=1e-9)


def test_grid(spark):
    points = spark.createDataFrame([(90.0, 180.0), (-90.0, -180.0), (41.2, -72.1), (0.0, 0.0)], "lat double, lon double")
    c = grid.cell(F.col("lat"), F.col("lon"), 9)
    rows = points.select("lat", "lon", c.alias("c"), grid.parent(c, 4).alias("p"), grid.cell(F.col("lat"), F.col("lon"), 4).alias("q"), grid.center_lat(c).alias("y"), grid.center_lon(c).alias("x"), grid.from_string(grid.to_string(c)).alias("s")).collect()
    for r in rows:
        assert r.p == r.q and r.s == r.c and abs(r.x - r.lon) <= 180 / 2**17 + 1e-9 and abs(r.y - r.lat) <= 90 / 2**16 + 1e-9
    assert points.select(grid.cell(F.lit(91.0), F.lit(0.0), 5)).first()[0] is None
    world = spark.range(2 ** (0 + grid.Y_BITS)).select(grid.area_km2(F.col("id")).alias("a")).agg(F.sum("a")).first()[0] * 2**grid.X_BITS
    assert world == pytest.approx(4 * math.pi * grid.EARTH_KM**2, rel=1e-9)


def test_polygon_with_hole_against_points(spark):
    outer, hole = [[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]], [[1, 1], [3, 1], [2, 3], [1, 1]]
    got = {r.cell for r in grid.polygon_cells(spark, [[outer, hole]], 2).collect()}
    nx, ny = 2 ** (2 + grid.X_BITS), 2 ** (2 + grid.Y_BITS)

    def within(x, y, ring):
        return sum((y0 <= y) != (y1 <= y) and x < x0 + (y - y0) / (y1 - y0) * (x1 - x0) for (x0, y0), (x1, y1) in zip(ring, ring[1:], strict=False)) % 2

    want = {(2 << 56) + i * 2**28 + j for i in range(nx // 2, nx // 2 + 15) for j in range(ny // 2, ny // 2 + 15) if within((i + 0.5) * 360 / nx - 180, (j + 0.5) * 180 / ny - 90, outer) != within((i + 0.5) * 360 / nx - 180, (j + 0.5) * 180 / ny - 90, hole)}
    assert got == want and got


def test_polygons_of_documents():
    ring = [[0, 0], [1, 0], [1, 1], [0, 0]]
    several = {"type": "MultiPolygon", "coordinates": [[ring], [ring]]}
    doc = {"type": "FeatureCollection", "features": [{"type": "Feature", "geometry": several}, {"type": "Feature", "geometry": {"type": "GeometryCollection", "geometries": [several]}}]}
    assert list(region.polygons(doc)) == [[ring]] * 4 and list(region.polygons({"type": "FeatureCollection", "features": []})) == []
    with pytest.raises(ValueError):
        list(region.polygons({"type": "Point", "coordinates": [0, 0]}))


def test_region_of_overlapping_polygons(spark):
    box = lambda w, s, e, n: [[[w, s], [e, s], [e, n], [w, n], [w, s]]]
    shape = region.Region(spark, [box(0, 0, 10, 10), box(5, 5, 20, 12), box(10, 0, 12, 3)], 2)
    cells = [r.h3 for r in shape.cells().collect()]
    assert len(cells) == len(set(cells)) == shape.area().first().region_cells
    total = shape.cells().agg(F.sum(grid.area_km2(F.col("h3")))).first()[0]
    assert shape.area().first().region_km2 == pytest.approx(total, abs=0.01)
    points = spark.createDataFrame([(float(x), float(y)) for x in range(-2, 23) for y in range(-2, 15)], "lon_d double, lat_d double")
    got = {(r.lon_d, r.lat_d) for r in shape.inside(points).collect()}
    want = {(r.lon_d, r.lat_d) for r in points.withColumn("h3", grid.cell(F.col("lat_d"), F.col("lon_d"), 2)).join(shape.cells(), "h3", "left_semi").collect()}
    assert got == want and got


def test_classify_ways_agree_and_hot_keys_split(spark):
    rows = [(k, f"f{i % 7}", f"p{i % 3}" if i % 11 else None, datetime(2026, 1, 1 + i % 5) if i % 13 else None, i) for i, k in enumerate("hhhhhhhhhhhhabcahhhhhbbh" * 5)]
    df = spark.createDataFrame(rows, "key string, file string, unique_id string, ingested timestamp, n int")
    a, b = ({r.n: r["class"] for r in f(df).collect()} for f in (classify, classify_by_window))
    unique = {n for n, c in a.items() if c == "unique"}
    assert a == b and len(a) == len(rows) and len(unique) == 4
    lost = df.withColumn("key", F.when(F.col("key") != "h", F.col("key")))
    a, b = ({r.n: r["class"] for r in f(lost).collect()} for f in (classify, classify_by_window))
    assert a == b and len(a) == len(rows)  # a null key is a key
    plan = classify(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition(key" in plan and "ingested" in plan  # the window is by key, file and the like, not by key alone


def test_overlap_against_all_pairs(spark):
    import random

    rnd = random.Random(4)

    def group(i):
        a, b = sorted(rnd.choice(["2026-01-05T", "2026-02-20T", "2026-04-01T", "not-a-time", "2025-12-31T"]) + str(rnd.randint(10, 20)) for _ in range(2))
        x, y = rnd.uniform(0, 3), rnd.uniform(0, 3)
        return (f"f{i}", "u", rnd.choice(["P", "Q"]), a, b, x, x + rnd.random(), y, y + rnd.random(), rnd.choice(["live", "removed"]), rnd.choice([0, 3]), rnd.choice([None, f"k{i}"]))

    ddl = "file string, unique_id string, provider string, t_min string, t_max string, lon_min double, lon_max double, lat_min double, lat_max double, status string, n_unique long, key string"
    index, new = [group(i) for i in range(120)], [group(i) for i in range(25)]
    got = {r.file for r in match.overlapping(spark.createDataFrame(new, ddl), spark.createDataFrame(index, ddl)).collect()}
    want = {i[0] for i in index for n in new if i[9] == "live" and i[10] > 0 and i[11] and i[2] == n[2] and i[3] <= n[4] and i[4] >= n[3] and i[5] <= n[6] and i[6] >= n[5] and i[7] <= n[8] and i[8] >= n[7]}
    assert got == want and got


def test_budget(spark):
    df = spark.createDataFrame([(f"{i:03d}", 10) for i in range(50)], "name string, size long")
    names = lambda n, s: sorted(r.name for r in match.within_budget(df, ["name"], "size", n, s).collect())
    assert names(7, 10**9) == [f"{i:03d}" for i in range(7)] and len(names(50, 95)) == 9 and names(5, 1) == ["000"]


def test_glitch(spark):
    rows = [("f", "p", "q", f"k{i}", f"2026-09-02T20:0{i}:00Z", -72.4, 41.0 + i) for i in range(2)]
    df = spark.createDataFrame(rows, "file string, unique_id string, provider string, key string, time string, lon_d double, lat_d double")
    assert [r.band for r in tracks.minutes(df).collect()] == ["glitch", "glitch"]


def test_antimeridian_tile_and_viewport(spark):
    points = spark.createDataFrame([(10.0, -179.9), (10.0, 179.9)], "lat double, lon double")
    tile = levels.tiles(points.select(grid.cell(F.col("lat"), F.col("lon"), 4).alias("cell")), 4)
    assert (tile.first().west, tile.first().east) == (-180.0, 180.0)
    assert levels.viewport(tile, 4, 0, 0, 1, 20).count() == 1 and levels.viewport(tile, 4, 0, 30, 1, 40).count() == 0
    assert [levels.resolution_of(z) for z in (2, 6, 9, 12)] == [4, 6, 8, 9]
    with pytest.raises(ValueError):
        levels.nearest(points, points, 0.5)


def test_undated_lag(spark):
    ddl = "file string, unique_id string, provider string, t_max string, ingested timestamp, n_rows long, n_unique long, status string"
    df = spark.createDataFrame([("f", "u", "p", "no time", datetime(2026, 1, 2), 1, 1, "live")], ddl)
    assert recent.published(df).first().lag_h == 0 and recent.published(df, undated_as_null=True).first().lag_h is None


def test_conform(spark):
    got = conform(spark.createDataFrame([("k", 1)], "key string, other int"), STATE["pending"])
    assert got.schema == struct(STATE["pending"]) and got.first().etag is None


def page(names, more=None):
    items = "".join(f'<Contents><Size>4</Size><Key>{n}</Key><ETag>"tag-{n[-5]}"</ETag><LastModified>2025-03-02T00:10:00.000Z</LastModified></Contents>' for n in names)
    return f'<ListBucketResult xmlns="http://s3.amazonaws.com/doc/2006-03-01/">{items}<IsTruncated>{"true" if more else "false"}</IsTruncated>{f"<NextContinuationToken>{more}</NextContinuationToken>" if more else ""}</ListBucketResult>'.encode()


def test_listing_goes_on_to_the_last_page():
    asked, answers = [], {"": page(["p/a.csv", "p/readme.txt"], "next one"), "next one": page(["p/b.csv"])}

    def get(target):
        query = urllib.parse.parse_qs(target.removeprefix("/?"))
        asked.append(query["prefix"][0])
        return answers[query.get("continuation-token", [""])[0]]

    got = list(archives.listed_below(get, "p/"))
    assert [c["key"] for c in got] == [["p/a.csv"], ["p/b.csv"]] and asked == ["p/", "p/"]
    assert got[1] == {"key": ["p/b.csv"], "size": [4], "etag": ["tag-b"], "last_modified": ["2025-03-02T00:10:00.000Z"]}


class Server:
    """Answers in turn; counts connections and pauses."""

    def __init__(self, *answers):
        self.answers, self.opened, self.pauses = list(answers), 0, []

    def connection(self):
        return archives.Connection("host", connect=self.connect, sleep=self.pauses.append)

    def connect(self, host, timeout):
        self.opened += 1
        return self

    def request(self, method, target):
        assert method == "GET"

    def getresponse(self):
        answer = self.answers.pop(0)
        if isinstance(answer, Exception):
            raise answer
        self.status, self.body = answer
        return self

    def read(self):
        return self.body


@pytest.mark.parametrize("faults", [[], [TimeoutError()], [http.client.IncompleteRead(b""), (503, b"")], [(200, b"abc"), ConnectionResetError(), (500, b"")]])
def test_faults_are_waited_out(faults):
    server = Server((200, b"abcd"), *faults, (200, b"abcd"))
    connection = server.connection()
    assert connection.get("/x", 4) == connection.get("/x", 4) == b"abcd"
    assert len(server.pauses) == len(faults) and server.opened == 1 + len(faults)


def test_refusals_and_lasting_faults_are_final():
    refusing = Server((403, b""))
    with pytest.raises(archives.Refused):
        refusing.connection().get("/x")
    lasting = Server(*[TimeoutError()] * 9)
    with pytest.raises(TimeoutError):
        lasting.connection().get("/x")
    assert (refusing.pauses, len(lasting.pauses)) == ([], len(archives.Connection.PAUSES))


def test_fetched_files_become_rows(spark):
    header = ",".join(struct(PUBLISHED).names)
    files = [("a/2025/03/02/x.csv", f'{header}\r\nu,f,1.0,2.0,3.0,t,"name, with comma",p\r\n\r\n'.encode()), ("a/2025/03/02/y.csv", f"{header}\n".encode())]
    rows = archives.parsed(spark.createDataFrame(files, "key string, content binary")).collect()
    assert [(r.file, r.UNIQUE_ID, r.PLATFORM_NAME, r.PROVIDER) for r in rows] == [("x.csv", "u", "name, with comma", "p")]
    with pytest.raises(Exception, match="unexpected header"):
        archives.parsed(spark.createDataFrame([("z.csv", b"LAT,LON\n1,2\n")], "key string, content binary")).collect()


def test_listing_of_a_folder(spark, tmp_path):
    paths = publish(tmp_path, "line", "strait")
    (tmp_path / "csb/csv/readme.txt").write_text("no")
    archive = archives.Folder(str(tmp_path))
    every = {r["name"]: r for r in archive.listing(spark).collect()}
    assert set(every) == {p.name for p in paths.values()} and every[paths["line"].name]["size"] == paths["line"].stat().st_size
    assert [r["name"] for r in archive.listing(spark, [date(2025, 3, 3), date(2031, 1, 1)]).collect()] == [paths["strait"].name]
    key = every[paths["line"].name]["key"]
    assert key == paths["line"].relative_to(tmp_path).as_posix() and one(spark, archives.day_of(F.col("x")), x=key) == date(2025, 3, 2)
    assert one(spark, archives.day_of(F.col("x")), x="notes/2025/13/77/a.csv") is None
    publish(tmp_path, "line")
    paths["line"].write_text(paths["line"].read_text() + "\n")
    assert next(r["etag"] for r in archive.listing(spark).collect() if r["name"] == paths["line"].name) != every[paths["line"].name]["etag"]
    assert archives.Folder(str(tmp_path / "none")).listing(spark).isEmpty()


def test_stream_equals_batch(spark, tmp_path):
    publish(tmp_path / "b")
    query = ingest.start(ingest.read_stream(spark, str(tmp_path / "b"), files_per_trigger=100), str(tmp_path / "out"), str(tmp_path / "cp"))
    query.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out" / "classified"))
    assert (got.count(), got.where("class = 'unique'").count()) == WHOLE[:2]


def test_stream_in_small_batches_and_windows(spark, tmp_path):
    publish(tmp_path / "b")
    readings = ingest.read_stream(spark, str(tmp_path / "b"), bytes_per_trigger=600)
    ingest.start(readings, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(240)
    got = spark.read.parquet(str(tmp_path / "out" / "classified"))
    assert got.select("batch").distinct().count() > 1 and got.count() == WHOLE[0]
    held = ingest.windowed(ingest.read_stream(spark, str(tmp_path / "b"))).writeStream.format("memory").queryName("windows").outputMode("complete").trigger(availableNow=True).start()
    held.awaitTermination(120)
    rows = spark.table("windows").collect()
    assert sum(r.n_rows for r in rows) == WHOLE[0] and all(r.platforms == 1 for r in rows)


def test_projection_needs_its_package(spark):
    with pytest.raises(RuntimeError):
        projection.square(spark.range(1))


@pytest.mark.parametrize("name", ["classify_daily", "fingerprint", "underway_rollup", "archive_level", "pub_strip", "stream_classify"])
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    con.execute("CREATE VIEW events AS SELECT * FROM '/root/testdata/sf0.001/events.parquet'")
    got = queries.QUERIES[name](spark, "/root/testdata/sf0.001")
    want = con.sql(queries.ORACLES[name])
    order = sorted(got.columns)
    assert order == sorted(want.columns)
    rows = lambda data, names: sorted(tuple(str(r[names.index(c)]) for c in order) for r in data)
    assert rows([tuple(r) for r in got.collect()], got.columns) == rows(want.fetchall(), list(want.columns))


def test_every_query_has_a_name_of_its_own():
    assert set(queries.ORACLES) <= set(queries.QUERIES) and len(queries.QUERIES) > 40
