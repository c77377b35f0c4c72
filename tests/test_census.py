"""The census end to end on the small archive of `observations`."""

from __future__ import annotations

import json
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from observations import A1, A2, A3, DELIVERIES, E1, NONSENSE, NOW, SEEDED, VOYAGE_MINUTES, WHOLE, Delivery, deliver, publish, voyage
from pyspark.sql import functions as F

from fathomline.cli import main, parser
from fathomline.functions import grid
from fathomline.operators import levels, rollup
from fathomline.plans import census, incremental, layers, reconcile, replay, seed
from fathomline.plans.ledger import Damaged, Ledger, Stale, pull, push
from fathomline.sources.archives import AsOf, Folder
from fathomline.sources.readings import keyed

SUMS = ("n_rows", "n_unique", "n_dup_resend", "n_dup_cross_id")


def full(spark, bucket: Path, out: Path, before: datetime | None = None) -> str:
    archive = Folder(str(bucket))
    census.stage(spark, keyed(archive.published(spark, archive.listing(spark))), str(out), "all")
    census.rank(spark, str(out), before)
    return census.finalize(spark, str(out), before)


def by_file(df) -> dict[str, tuple]:
    return {r["file"]: tuple(r[c] for c in SUMS) for r in df.collect()}


def whole(df) -> tuple:
    return tuple(df.agg(*(F.sum(c) for c in SUMS)).first())


def grown(spark, tmp: Path, *later: str) -> tuple[Ledger, Folder]:
    """A ledger seeded with the first two deliveries, and the archive as it is afterwards."""
    publish(tmp / "bucket", "line", "handover")
    full(spark, tmp / "bucket", tmp / "seed")
    ledger, archive = Ledger(spark, str(tmp / "ledger")), Folder(str(tmp / "bucket"))
    seed.seed(spark, str(tmp / "seed"), ledger, archive, now=SEEDED)
    publish(tmp / "bucket", *(later or tuple(DELIVERIES)[2:]))
    return ledger, archive


def same(a, b) -> bool:
    return sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def live(ledger: Ledger, what: str):
    make = {"cells": rollup.live_cells, "vdays": rollup.live_vessel_days}[what]
    return make(rollup.base_plus_delta(ledger.read(f"{what}_base"), ledger.read(f"{what}_delta")))


def test_every_delivery_is_counted_as_it_should(spark, tmp_path):
    publish(tmp_path / "b")
    index = spark.read.parquet(full(spark, tmp_path / "b", tmp_path / "o"))
    assert by_file(index) == {d.name: d.counts for d in DELIVERIES.values()} and whole(index) == WHOLE
    prints = {r["file"]: r["fingerprint"] for r in index.collect()}
    of = lambda name: prints[DELIVERIES[name].name]
    assert of("line") == of("line again") and of("strait") == of("strait again") != of("overlap")
    kinds = dict(index.dtypes)
    assert all(kinds[c] == "bigint" for c in SUMS) and kinds["fingerprint"] == "decimal(20,0)"


def test_batches_replace_themselves_and_make_the_census_stale(spark, tmp_path):
    out, archive = str(tmp_path / "o"), Folder(str(tmp_path / "b"))
    publish(tmp_path / "b", "line")
    deliver(tmp_path / "b", Delivery("20250305000500", "otter", "sound", (A1, NONSENSE), ()))
    days = {d: keyed(archive.published(spark, archive.listing(spark, [datetime.fromisoformat(d).date()]))) for d in ("2025-03-02", "2025-03-05")}
    for d in ("2025-03-02", "2025-03-05", "2025-03-02"):
        made = census.stage(spark, days[d], out, d).first()
    assert (made.files, made.rows, made.months) == (1, 4, ["2025-03"]) and census.batches(spark, out) == sorted(days)
    assert census.stage(spark, days["2025-03-05"], out, "2025-03-05").first().months == ["2025-03", "invalid"]
    assert not census.ranked(spark, out)
    with pytest.raises(FileNotFoundError):
        census.rolled(spark, out, "daily")
    census.rank(spark, out)
    assert census.ranked(spark, out) and whole(spark.read.parquet(census.finalize(spark, out))) == (6, 5, 0, 1)
    assert census.rolled(spark, out, "daily").where("coll_day IS NULL AND h3_r5 IS NULL").agg(F.sum("n_rows")).first()[0] == 1
    # With a month less than before nothing of it is left, and the census goes.
    census.stage(spark, days["2025-03-02"], out, "2025-03-05")
    assert census.staged(spark, out).where("coll_month = 'invalid'").isEmpty() and not census.ranked(spark, out)


def test_as_of_a_moment(spark, tmp_path):
    publish(tmp_path / "b")
    index = full(spark, tmp_path / "b", tmp_path / "o", before=datetime(2025, 3, 3, 12))
    assert whole(spark.read.parquet(index)) == tuple(map(sum, zip(*(DELIVERIES[n].counts for n in ("line", "handover", "strait", "line again")), strict=True)))
    archive = AsOf(Folder(str(tmp_path / "b")), SEEDED)
    assert {r["name"] for r in archive.listing(spark).collect()} == {DELIVERIES[n].name for n in ("line", "handover")}


@pytest.mark.parametrize("cap", [100, 2])
def test_runs_add_up_to_the_full_census(spark, tmp_path, cap):
    ledger, archive = grown(spark, tmp_path)
    results = []
    while (r := incremental.run(spark, ledger, archive, NOW, f"r{len(results)}", max_files=cap)).new_files:
        results.append(r)
    assert [r.capped for r in results] == ([False] if cap == 100 else [True, True, False])
    assert by_file(ledger.read("file_index")) == {d.name: d.counts for d in DELIVERIES.values()}
    # The repeated line is found by its fingerprint; the repeated strait only once the strait is in the index.
    assert sum(r.fingerprint_groups for r in results) == (1 if cap == 100 else 2)
    out = str(tmp_path / "full")
    full(spark, tmp_path / "bucket", tmp_path / "full")
    assert same(live(ledger, "cells"), rollup.live_cells(census.rolled(spark, out, "cells_r9")))
    assert same(live(ledger, "vdays"), rollup.live_vessel_days(census.rolled(spark, out, "vdays_r8")))
    # Adding rows has added parts; nothing is written again.
    assert len(ledger.snapshot.tables["file_index"]) == 1 + len(results)
    before = ledger.number
    assert incremental.run(spark, ledger, archive, NOW, "none").generation == before == Ledger(spark, ledger.root).number


def test_a_broken_run_leaves_no_trace(spark, tmp_path):
    ledger, archive = grown(spark, tmp_path)

    class Unreachable(Folder):
        def published(self, spark, objects):
            raise ConnectionError

    before = ledger.snapshot
    with pytest.raises(ConnectionError):
        incremental.run(spark, ledger, Unreachable(archive.root), NOW, "r")
    assert Ledger(spark, ledger.root).snapshot == before
    assert incremental.run(spark, ledger, archive, NOW, "r").new_rows == WHOLE[0] - 7


def test_what_has_to_be_read_again(spark, tmp_path):
    ledger, archive = grown(spark, tmp_path, "line again")
    copy = incremental.run(spark, ledger, archive, NOW, "a")
    assert (copy.fingerprint_groups, copy.reread_files, copy.n_dup_resend) == (1, 0, 4)
    publish(tmp_path / "bucket", "strait")
    assert incremental.run(spark, ledger, archive, NOW, "b").reread_files == 0  # another provider, another place
    publish(tmp_path / "bucket", "mixture")
    assert incremental.run(spark, ledger, archive, NOW, "c").reread_files == 2  # the line and the handover
    # The line once more, by another boat of another provider.
    deliver(tmp_path / "bucket", Delivery("20250304050500", "skua", "other", DELIVERIES["line"].readings, ()))
    last = incremental.run(spark, ledger, archive, NOW, "d")
    assert (last.fingerprint_groups, last.n_dup_cross_id) == (1, 4)


def test_reconcile(spark, tmp_path):
    ledger, archive = grown(spark, tmp_path)
    incremental.run(spark, ledger, archive, NOW, "r")
    rows = live(ledger, "cells").agg(F.sum("n_rows")).first()[0]
    gone, changed = DELIVERIES["strait"], DELIVERIES["mixture"]
    (tmp_path / "bucket/csb/csv" / gone.when.strftime("%Y/%m/%d") / gone.name).unlink()
    deliver(tmp_path / "bucket", Delivery(changed.stamp, changed.boat, changed.provider, (*changed.readings, A3), ()))
    got = reconcile.reconcile(spark, ledger, archive, NOW)
    assert (got.listed, got.removed, got.republished, got.newly_pending) == (7, 2, 1, 1)
    assert rows - live(ledger, "cells").agg(F.sum("n_rows")).first()[0] == 6
    assert {(r["provider"], r["reason"]) for r in ledger.read("queue").collect()} == {("strait", "removed original"), ("sound", "removed original")}
    assert {r["file"] for r in ledger.read("file_index").where("status = 'removed'").collect()} == {gone.name, changed.name}
    again = incremental.run(spark, ledger, archive, NOW, "s")
    assert (again.new_files, again.new_rows) == (1, 4) and ledger.read("pending").isEmpty()


def test_layers(spark, tmp_path):
    ledger, archive = grown(spark, tmp_path)
    deliver(tmp_path / "bucket", voyage())
    incremental.run(spark, ledger, archive, NOW, "r")
    site = tmp_path / "site"
    meta = layers.build(spark, ledger, str(site), providers=True, now=NOW)
    rows, unique = WHOLE[0] + 84, WHOLE[1] + 84
    assert (meta["published"], meta["unique"], meta["files"]) == (rows, unique, 9)
    for res in (4, 6, 8, 9):
        assert tuple(spark.read.parquet(str(site / "layers" / f"r{res}")).agg(F.sum("n_published"), F.sum("n_unique")).first()) == (rows, unique)
    for tile in json.loads((site / "layers/manifest.json").read_text())["tiles"]:
        w, s, e, n = tile["bbox"]
        cells = spark.read.parquet(*(str(site / f) for f in tile["files"])).select(grid.from_string(F.col("h3")).alias("c"))
        inside = grid.center_lon(F.col("c")).between(w, e) & grid.center_lat(F.col("c")).between(s, n)
        assert cells.where(inside).count() == cells.count() == tile["rows"] and tile["bytes"] > 0
    hours = spark.read.parquet(str(site / "layers/r4")).agg(F.sum("underway_h"), F.sum("stationary_h")).first()
    assert tuple(hours) == pytest.approx((VOYAGE_MINUTES[0] / 60, VOYAGE_MINUTES[1] / 60), abs=0.12)
    recent = json.loads((site / "recent.json").read_text())
    assert recent["strip"]["7d"]["files"] == 9 and recent["strip"]["24h"]["files"] == 5 and set(recent["providers"]) == {"sound", "strait"}
    assert sum(n for _, n in recent["lag_hist"]["all"]) == 9 and recent["runs"]["rows"]
    series = json.loads((site / "timeseries_month.json").read_text())
    assert sum(r[1] for r in series["community"]) == rows and sum(r[2] for r in series["reach"]["rows"]) == spark.read.parquet(str(site / "layers/r8")).count()


def test_minutes_from_files_equal_those_of_runs(spark, tmp_path):
    ledger, archive = grown(spark, tmp_path)
    deliver(tmp_path / "bucket", voyage())
    incremental.run(spark, ledger, archive, NOW, "r")
    first = seed.seed_underway(spark, ledger, str(tmp_path / "cache"), archive, chunk=3)
    base = ledger.read("uw_base").persist()
    gull = base.where("platform = 'gull'").agg(*(F.sum(c) for c in ("min_underway", "min_stationary", "min_other", "n_soundings"))).first()
    assert tuple(gull) == VOYAGE_MINUTES and first["files_read"] >= 6 and first["chunks"] >= 2
    rows = sorted(map(str, base.collect()))
    assert seed.seed_underway(spark, ledger, str(tmp_path / "cache"), archive)["files_read"] == 0
    assert sorted(map(str, ledger.read("uw_base").collect())) == rows and ledger.read("uw_delta").isEmpty()


def test_region(spark, tmp_path):
    ledger, archive = grown(spark, tmp_path)
    incremental.run(spark, ledger, archive, NOW, "r")
    w, s, e, n = 10.2, 55.3, 10.6, 55.6  # the sound
    polygon = tmp_path / "sound.geojson"
    polygon.write_text(json.dumps({"type": "Feature", "properties": {}, "geometry": {"type": "Polygon", "coordinates": [[[w, s], [e, s], [e, n], [w, n], [w, s]]]}}))
    summary = layers.build_region(spark, ledger, str(polygon), str(tmp_path / "region"))
    assert (summary["all_time"]["unique"], summary["all_time"]["providers"]) == (7, 1) and summary["by_year"]["2025"]["unique"] == 7
    width, height = 0.4 * 111.19 * 0.568, 0.3 * 111.19
    assert summary["region_km2"] == pytest.approx(width * height, rel=0.02)
    assert (tmp_path / "region/r9.parquet").is_file()
    full(spark, tmp_path / "bucket", tmp_path / "full")
    assert layers.extract_region(spark, census.staged(spark, str(tmp_path / "full")), str(polygon), str(tmp_path / "x")) == 7
    copies = {r["time"]: r["n_copies"] for r in spark.read.parquet(str(tmp_path / "x/readings.parquet")).collect()}
    assert (copies[A1.time], copies[A2.time], copies[E1.time]) == (2, 3, 1)


def test_replay_gate(spark, tmp_path):
    publish(tmp_path / "bucket")
    full(spark, tmp_path / "bucket", tmp_path / "full")
    start, end = datetime(2025, 3, 3), datetime(2025, 3, 4)
    report = replay.replay(spark, str(tmp_path / "full"), Ledger(spark, str(tmp_path / "ledger")), Folder(str(tmp_path / "bucket")), start, end, step_hours=12, grace_hours=1)
    assert report["pass"] and report["replay"] == report["census"] == [12, 5, 6, 1]


def test_the_ledger(spark, tmp_path):
    one = spark.createDataFrame([("k", "e")], "key string, etag string")
    here = Ledger(spark, str(tmp_path / "here"))
    for _ in range(5):
        here.commit({"pending": one})
    here.commit(append={"pending": one}, listed_until="2025-03-04")
    assert here.read("pending").count() == 2 and here.fact("listed_until") == "2025-03-04" and here.number == 6
    assert sorted(p.name for p in (tmp_path / "here/log").glob("0*")) == [f"{n:08}.json" for n in (4, 5, 6)]
    assert len(list((tmp_path / "here/parts").iterdir())) == 3  # of the last three snapshots
    with pytest.raises(ValueError):
        here.commit({"nothing": one})
    late = Ledger(spark, here.root)
    here.commit({"pending": one})
    with pytest.raises(Stale):
        late.commit({"pending": one})


def test_many_parts_are_merged(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("fathomline.plans.ledger.MERGED", 3)
    ledger, one = Ledger(spark, str(tmp_path)), spark.createDataFrame([("k", "e")], "key string, etag string")
    sizes = []
    for _ in range(5):
        ledger.commit(append={"pending": one})
        sizes.append(len(ledger.snapshot.tables["pending"]))
    assert sizes == [1, 2, 3, 1, 2] and ledger.read("pending").count() == 5


def test_following_a_ledger(spark, tmp_path):
    one = spark.createDataFrame([("k", "e")], "key string, etag string")
    here, remote, there = (Ledger(spark, str(tmp_path / n)) for n in ("here", "remote", "there"))
    here.commit({"pending": one})
    with pytest.raises(FileNotFoundError):
        pull(there, remote)
    with pytest.raises(FileNotFoundError):
        push(here, remote)
    push(here, remote, found=True)
    push(here, remote)
    pull(there, remote)
    assert there.snapshot.id == here.snapshot.id and there.read("pending").count() == 1
    there.commit(append={"pending": one})
    push(there, remote)
    here.commit({"pending": one})
    with pytest.raises(Stale):
        push(here, remote)
    pull(here, remote)
    assert Ledger(spark, here.root).read("pending").count() == 2
    # A file of the same size with other bytes is found by its hash only; a lost one by its size; both are fetched again.
    part = next((tmp_path / "here/parts").glob("*/*.parquet"))
    kept = part.read_bytes()
    part.write_bytes(kept[:20] + bytes([kept[20] ^ 1]) + kept[21:])
    (part.parent / f".{part.name}.crc").unlink()
    here.check()
    with pytest.raises(Damaged):
        here.check(deep=True)
    part.unlink()
    with pytest.raises(Damaged):
        here.check()
    pull(here, remote)
    here.check(deep=True)


def test_command_line(spark, tmp_path, capsys):
    publish(tmp_path / "bucket")
    at = lambda name: str(tmp_path / name)
    local = ["--local", at("bucket")]
    assert main(["backfill", "--out", at("o"), "--start", "2025-03-02", "--end", "2025-03-02", *local]) == 0
    assert main(["seed", "--backfill", at("o"), "--state", at("s"), *local]) == 0
    assert main(["incremental", "--state", at("s"), "--now", NOW.isoformat(), *local]) == 0
    assert main(["push", "--state", at("s"), "--remote", at("r"), "--init"]) == 0 and main(["pull", "--state", at("t"), "--remote", at("r")]) == 0
    assert main(["layers", "--state", at("t"), "--out", at("site"), "--now", NOW.isoformat()]) == 0
    assert f'"unique": {WHOLE[1]}' in capsys.readouterr().out
    for command in ("backfill", "rank", "seed", "incremental", "reconcile", "underway-seed", "replay", "pull", "push", "layers", "region", "extract"):
        with pytest.raises(SystemExit) as end:
            parser().parse_args([command, "--help"])
        assert end.value.code == 0


def test_ages_of_recent_rows(spark):
    ddl = "unique_id string, day string, h3_r9 long, n_rows long, n_unique long, ingested timestamp"
    seen = NOW.replace(tzinfo=None) - timedelta(hours=6)
    rows = spark.createDataFrame([("p", "2025-03-02", 1, 2, 1, seen), ("p", None, 1, 2, 1, seen)], ddl)
    now = F.lit(f"{NOW:%Y-%m-%d %H:%M:%S}").cast("timestamp")
    assert sorted(r["age_d"] for r in levels.recent_rows(rows, now).collect()) == [0.0, 2.25]
    assert sorted(str(r["age_d"]) for r in levels.recent_rows(rows, now, undated_as_null=True).collect()) == ["2.25", "None"]
