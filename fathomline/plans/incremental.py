"""Incremental census: classify what was published since the last run, so that the result equals a full census."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import UTC, date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomline.functions.schema import STATE, struct
from fathomline.operators import match, rollup, tracks
from fathomline.operators.classify import ORDER, classify, tallies
from fathomline.operators.recent import moment
from fathomline.plans.ledger import Ledger
from fathomline.plans.work import Work
from fathomline.session import ensure
from fathomline.sources.archives import Archive, day_of
from fathomline.sources.readings import keyed

#: Days for which cells are held by file, and days listed again before the newest file.
RECENT_DAYS, LOOKBACK = 30, 3
MAX_FILES, MAX_BYTES = 4000, 3_000_000_000
NEWEST, LISTED = "newest_file", "listed_until"


@dataclass(frozen=True)
class RunResult:
    run_id: str
    generation: int
    new_files: int = 0
    new_rows: int = 0
    n_unique: int = 0
    n_dup_resend: int = 0
    n_dup_cross_id: int = 0
    fingerprint_groups: int = 0
    reread_files: int = 0
    reread_bytes: int = 0
    capped: bool = False


def size() -> Column:
    """The number of a step's rows."""
    return F.count("*").alias("n")


def naive(t: datetime) -> datetime:
    return t.astimezone(UTC).replace(tzinfo=None) if t.tzinfo else t


def days_to_list(ledger: Ledger, now: date, lookback: int) -> list[date]:
    """From `lookback` days before the newest file until now, and the days of keys that a reconcile found missing."""
    known = ledger.fact(NEWEST)
    newest = datetime.fromisoformat(known).date() if known else now
    days = {newest + timedelta(days=k) for k in range(-lookback, max(0, (now - newest).days) + 1)}
    waiting = ledger.read("pending").select(day_of(F.col("key")).alias("day")).where("day IS NOT NULL").distinct()
    return sorted(days | {r["day"] for r in waiting.collect()})


def run_row(spark: SparkSession, **values) -> DataFrame:
    """One row of the run log."""
    row = {f.name: values.get(f.name) for f in struct(STATE["runs"])}
    row["finished_at"] = naive(datetime.now(UTC))
    return spark.createDataFrame([tuple(row.values())], struct(STATE["runs"]))


def stamped(df: DataFrame, run_id: str) -> DataFrame:
    return df.withColumn("run_id", F.lit(run_id))


def classify_new(new: DataFrame, groups: DataFrame, matched: DataFrame, candidates: DataFrame) -> DataFrame:
    """Classes of new readings: of groups that repeat a live group from that group, of others by rank behind candidates."""
    by_group = ["file", "unique_id"]
    unmatched = groups.join(matched, by_group, "left_anti").select(*by_group)
    rows = new.join(unmatched, by_group, "left_semi")
    # Only candidates that share a key with a new reading can matter.
    held = candidates.join(rows.select("key").distinct(), "key", "left_semi").withColumn("phase", F.lit(0))
    ranked = classify(held.unionByName(rows.withColumn("phase", F.lit(1))), ("phase", *ORDER)).where("phase = 1").drop("phase")
    copies = new.join(matched.select(*by_group, "dup_uid"), by_group)
    copied = copies.withColumn("class", F.when(F.col("unique_id") == F.col("dup_uid"), "dup_resend").otherwise("dup_cross_id")).drop("dup_uid")
    return ranked.unionByName(copied)


def run(
    spark: SparkSession, ledger: Ledger, archive: Archive, now: datetime, run_id: str, max_files: int = MAX_FILES, max_bytes: int = MAX_BYTES, lookback_days: int = LOOKBACK
) -> RunResult:
    """One run. A failure before the commit leaves the ledger as it was; with nothing new nothing is committed."""
    ensure(spark)
    ledger.check()
    now = naive(now)
    index = ledger.read("file_index")
    # Every step is written down, so that plans stay short and a lost executor costs one step.
    with Work(spark, ledger.root) as work:
        fresh, waiting = work.measured(match.new_objects(archive.listing(spark, days_to_list(ledger, now.date(), lookback_days)), index), size())
        if not waiting.n:
            return RunResult(run_id, ledger.number)
        chosen, taken = work.measured(match.within_budget(fresh, ["name", "key"], "size", max_files, max_bytes), size(), F.max("last_modified").alias("newest"))
        new = work.keep(keyed(archive.published(spark, chosen)))
        groups, held = work.measured(rollup.group_meta(new), F.date_format(F.max("ingested"), "yyyy-MM-dd'T'HH:mm:ss").alias("newest"))
        matched, copied = work.measured(match.fingerprint_matches(groups, index), size())
        originals = match.overlapping(groups.join(matched, ["file", "unique_id"], "left_anti"), index)
        reread, again = work.measured(originals.select("key", "size", "etag").distinct(), size(), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"))
        classes, total = work.measured(classify_new(new, groups, matched, keyed(archive.published(spark, reread))), *tallies())

        counts = rollup.file_counts(classes)
        found = chosen.select(F.col("name").alias("file"), "key", "size", "etag", F.col("last_modified").alias("published_at"))
        method = F.when(F.col("dup_of").isNull(), "ranked").otherwise("fingerprint")
        entries = groups.join(counts.drop("n_rows"), ["file", "unique_id"]).join(found, "file").join(matched.drop("dup_uid"), ["file", "unique_id"], "left")
        minutes = tracks.underway(tracks.minutes(new, counts.where("n_unique > 0").select("file", "unique_id")), with_file=True)
        cutoff = moment(now - timedelta(days=RECENT_DAYS))
        log = run_row(
            spark, run_id=run_id, kind="incremental", run_at=now, generation=ledger.number + 1, new_files=taken.n, **total.asDict(),
            reread_bytes=again.bytes, capped=taken.n < waiting.n, removed=0, newest_published=taken.newest,
        )
        ledger.commit(
            replace={
                "recent_cells": ledger.read("recent_cells").where(F.col("ingested") >= cutoff).unionByName(rollup.recent_cells(classes)),
                "pending": ledger.read("pending").join(chosen.select("key"), "key", "left_anti"),
            },
            append={
                "file_index": stamped(entries.withColumns({"status": F.lit("live"), "method": method}), run_id),
                "file_months": rollup.file_month_counts(classes),
                "cells_delta": stamped(rollup.month_cells(classes), run_id),
                "vdays_delta": stamped(rollup.vessel_days(classes), run_id),
                "uw_delta": stamped(minutes, run_id),
                "runs": log,
            },
            **{NEWEST: max(filter(None, (held.newest, ledger.fact(NEWEST))), default=None), LISTED: now.date().isoformat()},
        )
        return RunResult(run_id, ledger.number, taken.n, total.n_rows, total.n_unique, total.n_dup_resend, total.n_dup_cross_id, copied.n, again.n, again.bytes, taken.n < waiting.n)
