"""Reconciliation of the index with the whole listing: removals and republished files, by signed deltas."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomline.functions import grid
from fathomline.operators.classify import summed
from fathomline.plans.incremental import naive, run_row, stamped
from fathomline.plans.ledger import Ledger
from fathomline.plans.work import Work
from fathomline.session import ensure
from fathomline.sources.archives import Archive


@dataclass(frozen=True)
class Reconciled:
    """Counts; `removed` and `republished` are (file, unique_id) groups."""

    generation: int
    listed: int
    removed: int
    republished: int
    newly_pending: int
    queued_months: int


def gone_groups(index: DataFrame, listed: DataFrame) -> DataFrame:
    """Live groups whose (key, etag) is not listed any more; `republished` if their key is, with another etag."""
    missing = index.where("status = 'live'").join(listed.select("key", "etag"), ["key", "etag"], "left_anti")
    again = listed.select("key", F.lit(True).alias("again")).distinct()
    return missing.join(again, "key", "left").select("file", "unique_id", "key", "provider", "n_unique", F.coalesce("again", F.lit(False)).alias("republished"))


def retract_cells(recent: DataFrame, gone: DataFrame) -> DataFrame:
    held = recent.join(gone.select("file", "unique_id"), ["file", "unique_id"], "left_semi")
    return held.groupBy("provider", "coll_month", "h3_r9").agg(*summed(-1))


def retract_vessel_days(recent: DataFrame, gone: DataFrame) -> DataFrame:
    held = recent.where("day IS NOT NULL AND h3_r9 IS NOT NULL").join(gone.select("file", "unique_id"), ["file", "unique_id"], "left_semi")
    return held.groupBy("provider", F.col("unique_id").alias("platform"), "day", grid.parent(F.col("h3_r9"), 8).alias("h3_r8")).agg(*summed(-1))


def retract_minutes(minutes: DataFrame, gone: DataFrame) -> DataFrame:
    held = minutes.join(gone.select("file", F.col("unique_id").alias("platform")), ["file", "platform"], "left_semi")
    names = ["min_underway", "min_slow", "min_stationary", "min_other", "n_soundings"]
    return held.groupBy("file", "provider", "platform", "day", "h3_r8").agg(*((-F.sum(n)).cast("long").alias(n) for n in names))


def mark_removed(index: DataFrame, gone: DataFrame, at) -> DataFrame:
    marks = gone.select("file", "unique_id", F.lit(True).alias("_gone")).distinct()
    hit = F.coalesce("_gone", F.lit(False)) & (F.col("status") == "live")
    joined = index.join(marks, ["file", "unique_id"], "left")
    return joined.withColumns({"removed_at": F.when(hit, at).otherwise(F.col("removed_at")), "status": F.when(hit, F.lit("removed")).otherwise(F.col("status"))}).select(*index.columns)


def recount_queue(gone: DataFrame, months: DataFrame, recent: DataFrame, at) -> DataFrame:
    """Months to be counted again: of originals, and of groups whose cells are no longer held by file."""
    held = recent.select("file", "unique_id", F.lit(True).alias("_held")).distinct()
    rows = gone.join(months.select("file", "unique_id", "coll_month"), ["file", "unique_id"]).join(held, ["file", "unique_id"], "left")
    reason = F.when(F.col("n_unique") > 0, "removed original").otherwise("removed, cells not held")
    return rows.where((F.col("n_unique") > 0) | F.col("_held").isNull()).select("provider", "coll_month", reason.alias("reason"), at.alias("queued_at")).distinct()


def reconcile(spark: SparkSession, ledger: Ledger, archive: Archive, now: datetime) -> Reconciled:
    ensure(spark)
    ledger.check()
    now = naive(now)
    at = F.lit(now).cast("timestamp")
    run_id = f"reconcile-{now:%Y%m%dT%H%M}"
    index, recent, pending = (ledger.read(t) for t in ("file_index", "recent_cells", "pending"))
    with Work(spark, ledger.root) as work:
        listed = work.keep(archive.listing(spark))
        gone = work.keep(gone_groups(index, listed))
        removed, republished = gone.agg(F.count("*"), F.count_if("republished")).first()
        missed = work.keep(listed.select("key", "etag").join(index.select("key", "etag"), ["key", "etag"], "left_anti").join(pending.select("key", "etag"), ["key", "etag"], "left_anti"))
        log = run_row(spark, run_id=run_id, kind="reconcile", run_at=now, generation=ledger.number + 1, new_files=0, n_rows=0, n_unique=0, n_dup_resend=0, n_dup_cross_id=0, reread_bytes=0, capped=False, removed=removed)
        signed = {"cells_delta": retract_cells(recent, gone), "vdays_delta": retract_vessel_days(recent, gone), "uw_delta": retract_minutes(ledger.read("uw_delta"), gone)}
        ledger.commit(
            replace={"file_index": mark_removed(index, gone, at), "recent_cells": recent.join(gone.select("file", "unique_id"), ["file", "unique_id"], "left_anti")},
            append={name: stamped(rows, run_id) for name, rows in signed.items()}
            | {"pending": missed.withColumn("seen_at", at), "queue": recount_queue(gone, ledger.read("file_months"), recent, at), "runs": log},
        )
        queued = ledger.read("queue").select("provider", "coll_month").distinct().count()
        return Reconciled(ledger.number, listed.count(), removed, republished, missed.count(), queued)
