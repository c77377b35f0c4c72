"""Validation gate: replay a stretch of time by incremental runs and compare with the full census."""

from __future__ import annotations

import time
from datetime import UTC, datetime, timedelta
from typing import Any

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from fathomline.operators.recent import moment
from fathomline.plans import census, incremental, seed
from fathomline.plans.ledger import Ledger
from fathomline.sources.archives import Archive, AsOf

SUMS = ("n_rows", "n_unique", "n_dup_resend", "n_dup_cross_id")


def replay(
    spark: SparkSession, out: str, ledger: Ledger, archive: Archive, start: datetime, end: datetime, step_hours: float = 6, grace_hours: float = 6, resume_at: datetime | None = None, tolerance: float = 1e-4
) -> dict[str, Any]:
    """Seed as of `start`, run every step to `end` and a grace beyond, then compare files stamped in between with the census `out`."""
    utc = lambda t: t if t.tzinfo else t.replace(tzinfo=UTC)
    start, end, at = utc(start), utc(end), utc(resume_at or start)
    if resume_at is None:
        before, then = incremental.naive(start), f"{ledger.root}-as-of-{start:%Y%m%dT%H%M}"
        census.rank(spark, out, before, then)
        census.finalize(spark, out, before, then)
        seed.seed(spark, then, ledger, AsOf(archive, start), now=start)
    stop, slowest, reread = end + timedelta(hours=grace_hours), 0.0, 0
    while at < stop:
        at = min(at + timedelta(hours=step_hours), stop)
        began = time.monotonic()
        reread += incremental.run(spark, ledger, AsOf(archive, at), at, f"replay-{at:%Y%m%dT%H%M}").reread_bytes
        slowest = max(slowest, time.monotonic() - began)
    span = (F.col("ingested") >= moment(incremental.naive(start))) & (F.col("ingested") < moment(incremental.naive(end)))
    total = [F.coalesce(F.sum(c), F.lit(0)) for c in SUMS]
    want = list(spark.read.parquet(f"{out}/census/file_index").where(span).agg(*total).first())
    got = list(ledger.read("file_index").where("status = 'live'").where(span).agg(*total).first())
    apart = abs(got[1] - want[1]) / max(1, want[1])
    return {"census": want, "replay": got, "unique_relative_difference": apart, "tolerance": tolerance, "pass": apart <= tolerance, "slowest_run_seconds": round(slowest), "reread_bytes": reread}
