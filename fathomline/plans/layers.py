"""Published files: map levels as partitioned Parquet with a tile manifest, and JSON summaries."""

from __future__ import annotations

from datetime import UTC, date, datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomline.functions import grid
from fathomline.functions.scalars import slug
from fathomline.operators import levels, recent, region, rollup
from fathomline.operators.levels import PARENT
from fathomline.plans.incremental import naive
from fathomline.plans.ledger import Ledger
from fathomline.session import ensure
from fathomline.sources.files import Files

ARCHIVE, FINE, LAST24 = (4, 6, 8), 9, (4, 6, 8, 9)
# Collection windows in days, with their levels.
WINDOWS = {"7d": (7, (4, 6, 8)), "30d": (30, (4, 6, 8)), "365d": (365, (4, 6))}


def text(value: Any) -> Any:
    return value.isoformat(timespec="minutes") if isinstance(value, datetime) else value


def table_doc(df: DataFrame, *order: str) -> dict[str, Any]:
    """A small result as columns and rows."""
    return {"columns": df.columns, "rows": [[text(v) for v in r] for r in df.orderBy(*order).collect()]}


def one_file(rows: DataFrame, path: str) -> None:
    """A small, ordered result as a file of its own: written by one task, then moved to its place."""
    files, passing = Files(rows.sparkSession), f"{path}.passing"
    rows.coalesce(1).write.mode("overwrite").option("compression", "zstd").parquet(passing)
    files.remove(path)
    files.move(f"{passing}/{next(n for n in files.names(passing) if n.endswith('.parquet'))}", path)
    files.remove(passing)


def write_level(rows: DataFrame, res: int, dest: str, url: str) -> list[dict[str, Any]]:
    """One level, split by parent cell and sorted within; returns its tiles (one for each parent)."""
    up = PARENT[res]
    part = F.lit("all") if up is None else grid.to_string(grid.parent(F.col("cell"), up))
    files = Files(rows.sparkSession)
    rows = rows.persist()
    named = rows.select(grid.to_string(F.col("cell")).alias("h3"), part.alias("part"), *(c for c in rows.columns if c != "cell"))
    named.repartition("part").sortWithinPartitions("part", "h3").write.mode("overwrite").option("compression", "snappy").partitionBy("part").parquet(dest)
    out = []
    for t in levels.tiles(rows, res).orderBy("part").collect():
        held = {n: size for n, size in sorted(files.names(f"{dest}/part={t['part']}").items()) if n.endswith(".parquet")}
        out.append({
            "res": res, "part": t["part"], "rows": t["rows"], "bbox": [t["west"], t["south"], t["east"], t["north"]],
            "files": [f"{url}/r{res}/part={t['part']}/{n}" for n in held], "bytes": sum(held.values()),
        })
    rows.unpersist()
    return out


class Live:
    """The ledger's live tables, each summed once."""

    def __init__(self, ledger: Ledger) -> None:
        def signed(base: str, delta: str) -> DataFrame:
            return rollup.base_plus_delta(ledger.read(base), ledger.read(delta))

        self.cells = rollup.live_cells(signed("cells_base", "cells_delta")).persist()
        self.vessel_days = rollup.live_vessel_days(signed("vdays_base", "vdays_delta")).persist()
        self.minutes = rollup.live_minutes(rollup.base_plus_delta(ledger.read("uw_base"), ledger.read("uw_delta").drop("file"))).persist()
        self.index, self.months = ledger.read("file_index"), ledger.read("file_months")
        self.recent, self.file_minutes, self.runs = ledger.read("recent_cells"), ledger.read("uw_delta"), ledger.read("runs")

    def close(self) -> None:
        for df in (self.cells, self.vessel_days, self.minutes):
            df.unpersist()


def strip_doc(df: DataFrame) -> dict[str, Any]:
    """Every window, with zeros where nothing was published."""
    zero = {n: None if n == "median_lag_h" else 0 for n in df.columns if n != "window"}
    found = {r["window"]: {k: v for k, v in r.asDict().items() if k != "window"} for r in df.collect()}
    return {name: found.get(name, zero) for name in recent.STRIP}


def recent_doc(live: Live, now: datetime, providers: bool) -> dict[str, Any]:
    pub = recent.published(live.index).persist()
    today, since = now.date().isoformat(), date.fromordinal(now.date().toordinal() - 400).isoformat()
    hist = lambda rows: [[r["bucket"], r["n"]] for r in recent.histogram(rows, "lag_h", recent.LAGS).orderBy("place").collect()]
    aged = levels.recent_rows(live.recent, recent.moment(now))
    ages = recent.histogram(aged, "age_d", recent.AGES, F.col("n_rows")).orderBy("place").collect()
    doc = {
        "now": now.isoformat(timespec="minutes"),
        "strip": strip_doc(recent.strip(pub, now)),
        "batches": table_doc(recent.batches(recent.since(pub, now, 30)), "batch"),
        "daily_pub": table_doc(recent.daily_published(recent.since(pub, now, 400)), "day"),
        "daily_coll": table_doc(recent.daily_collected(live.vessel_days.where((F.col("day") >= since) & (F.col("day") <= today))), "day"),
        "lag_hist": {"buckets": list(recent.LAGS), "last_30d": hist(recent.since(pub, now, 30)), "all": hist(pub)},
        "runs": {"columns": live.runs.columns, "rows": [[text(v) for v in r] for r in recent.newest_runs(live.runs).collect()]},
        "last24h": {"buckets": list(recent.AGES), "collected": [[r["bucket"], r["n"]] for r in ages]},
    }
    if providers:
        by = {r["provider"] for r in pub.select("provider").distinct().collect()}
        every = recent.strip(pub, now, ["provider"]).persist()
        doc["providers"] = {n: strip_doc(every.where(F.col("provider").eqNullSafe(F.lit(n))).drop("provider")) for n in sorted(by, key=str)}
        every.unpersist()
    pub.unpersist()
    return doc


def meta_doc(live: Live, ledger: Ledger, now: datetime, providers: bool) -> dict[str, Any]:
    whole = recent.totals(live.index).first().asDict()
    today, since = now.date().isoformat(), date.fromordinal(now.date().toordinal() - 30).isoformat()
    mapped = live.cells.agg(F.coalesce(F.sum("n_rows"), F.lit(0)), F.coalesce(F.sum("n_unique"), F.lit(0))).first()
    v = live.vessel_days.agg(F.count_distinct(F.concat("platform", F.lit("|"), "day")), F.count_distinct(F.when((F.col("day") > since) & (F.col("day") <= today), F.col("platform")))).first()
    spent, late = recent.platform_days(live.minutes).first().asDict(), recent.latency(live.runs, now).first().asDict()
    return {
        "generation": ledger.number, "built_at": datetime.now(UTC).isoformat(timespec="seconds"), **whole,
        "last_ingested": whole["last_ingested"].isoformat() if whole["last_ingested"] else None,
        "mapped_published": mapped[0], "mapped_unique": mapped[1], "vessel_days": v[0], "platforms_active_30d": v[1], "provider_views": providers,
        **{k: x or 0 if k.endswith("hours") else x for k, x in spent.items()}, "reach_cells_12m": recent.reach_since(live.cells, today).first()[0], **{k: text(x) for k, x in late.items()},
    }


def build(spark: SparkSession, ledger: Ledger, out: str, providers: bool = False, now: datetime | None = None) -> dict[str, Any]:
    """Write everything under `out`; returns the summary."""
    ensure(spark)
    ledger.check()
    if not ledger.has("cells_base", "file_index", "file_months"):
        raise FileNotFoundError(f"{ledger.root} holds no census: seed it")
    now, store = naive(now or datetime.now(UTC)), Files(spark)
    store.remove(out)
    live, today = Live(ledger), now.date().isoformat()
    every = {str(r): {"parent": PARENT[r]} for r in (*ARCHIVE, FINE)}
    base = f"{out}/layers"
    manifest: dict[str, Any] = {"levels": every, "tiles": [], "windows": {}}
    for res in ARCHIVE:
        manifest["tiles"] += write_level(levels.archive_level(live.cells, live.vessel_days, live.minutes, res), res, f"{base}/r{res}", "layers")
    fine = write_level(levels.cells_at(live.cells, FINE), FINE, f"{base}/r{FINE}", "layers")
    store.save(f"{base}/manifest_r{FINE}.json", {"tiles": fine})
    manifest["fine"] = {"res": FINE, "index": f"layers/manifest_r{FINE}.json", "tiles": len(fine)}
    for name, (days, resolutions) in WINDOWS.items():
        v, m = (levels.in_window(df, today, days) for df in (live.vessel_days, live.minutes))
        manifest["windows"][name] = [t for r in resolutions for t in write_level(levels.window_level(v, m, r), r, f"{base}/recent/{name}/r{r}", f"layers/recent/{name}")]
    rows = levels.recent_rows(live.recent, recent.moment(now))
    files = live.recent.where(F.col("ingested") >= recent.moment(now) - F.expr("interval 1 day")).select("file").distinct()
    spent = live.file_minutes.join(files, "file", "left_semi").withColumnRenamed("h3_r8", "h3")
    manifest["windows"]["24h"] = []
    for r in LAST24:
        # Minutes are held at level 8: below it a cell has none of its own.
        hours = spent if r <= 8 else spent.limit(0)
        manifest["windows"]["24h"] += write_level(levels.last24_level(rows, hours, r), r, f"{base}/recent/24h/r{r}", "layers/recent/24h")
    if providers:
        manifest["providers"] = {}
        for (name,) in live.cells.select("provider").distinct().orderBy("provider").collect():
            own = [df.where(F.col("provider") == F.lit(name)) for df in (live.cells, live.vessel_days, live.minutes)]
            url = f"layers/providers/{slug(name or '')}"
            manifest["providers"][name] = [t for r in (4, 6) for t in write_level(levels.archive_level(*own, r), r, f"{out}/{url}/r{r}", url)]
    store.save(f"{base}/manifest.json", manifest)
    meta = meta_doc(live, ledger, now, providers)
    store.save(f"{out}/meta.json", meta)
    months = table_doc(recent.month_series(live.months, live.index), "month")
    series: dict[str, Any] = {"columns": months["columns"], "community": months["rows"], "reach": table_doc(levels.reach_series(live.cells, live.minutes), "month")}
    if providers:
        series["providers"] = {}
        for r in recent.month_series(live.months, live.index, by_provider=True).orderBy("provider", "month").collect():
            series["providers"].setdefault(r["provider"], []).append([r["month"], *r[2:]])
    store.save(f"{out}/timeseries_month.json", series)
    store.save(f"{out}/recent.json", recent_doc(live, now, providers))
    live.close()
    return meta


def build_region(spark: SparkSession, ledger: Ledger, polygon: str, out: str) -> dict[str, Any]:
    """Coverage of a polygon from the ledger's cells."""
    ensure(spark)
    files, live = Files(spark), Live(ledger)
    shape = region.Region(spark, region.read_polygons(files, polygon), 9)
    inside = shape.within(live.cells).persist()
    area = shape.area().first()
    one_file(region.coverage_cells(inside).withColumn("h3", grid.to_string(F.col("h3"))).orderBy("h3"), f"{out}/r9.parquet")
    doc = lambda r: {k: v for k, v in r.asDict().items() if k != "year"}
    none = {"unique": 0, "published": 0, "cells_ge1": 0, "cells_ge100": 0, "km2_covered": 0.0, "providers": 0, "share_ge1": 0.0, "share_ge100": 0.0}
    whole = region.coverage(inside, area["region_cells"]).first()
    years = region.coverage(inside, area["region_cells"], by_year=True).orderBy("year").collect()
    summary = {"polygon": polygon.rpartition("/")[2], "resolution": 9, **area.asDict(), "all_time": doc(whole) if whole else none, "by_year": {r["year"]: doc(r) for r in years}}
    files.save(f"{out}/summary.json", summary)
    inside.unpersist()
    shape.close()
    live.close()
    return summary


def extract_region(spark: SparkSession, readings: DataFrame, polygon: str, out: str, res: int = 10) -> int:
    """Originals of staged readings inside a polygon; returns how many."""
    shape = region.Region(spark, region.read_polygons(Files(spark), polygon), res)
    rows = shape.inside(readings).persist()
    region.extract(rows, res).orderBy("time").write.mode("overwrite").option("compression", "zstd").parquet(f"{out}/readings.parquet")
    one_file(region.extract_cells(rows).withColumn("h3", grid.to_string(F.col("h3"))).orderBy("h3"), f"{out}/r{res}.parquet")
    n = rows.select("key").distinct().count()
    rows.unpersist()
    shape.close()
    return n
