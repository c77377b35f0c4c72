"""Seeding: a ledger from a full census, and the minutes of all live tracks from published files."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from fathomline.functions.scalars import parse_stamp
from fathomline.functions.schema import STATE, struct
from fathomline.operators import tracks
from fathomline.operators.classify import summed
from fathomline.plans import census
from fathomline.plans.incremental import NEWEST, naive
from fathomline.plans.ledger import Ledger
from fathomline.session import ensure
from fathomline.sources.archives import Archive
from fathomline.sources.files import Files
from fathomline.sources.readings import keyed


def seed(spark: SparkSession, out: str, ledger: Ledger, archive: Archive, now: datetime | None = None) -> int:
    """Fill an empty ledger from a census; returns its snapshot's number."""
    ensure(spark)
    if ledger.number:
        raise ValueError(f"{ledger.root} has a history already")
    cells = census.rolled(spark, out, "cells_r9")
    index = spark.read.parquet(f"{out}/census/file_index")
    listed = archive.listing(spark).persist()
    by_name = listed.select(F.col("name").alias("file"), "key", "size", "etag", F.col("last_modified").alias("published_at"))
    here = F.col("key").isNotNull()
    at = F.lit(naive(now)).cast("timestamp") if now else F.current_timestamp()
    entries = index.join(by_name, "file", "left").withColumns({"status": F.when(here, "live").otherwise("removed"), "removed_at": F.when(~here, at), "method": F.lit("ranked"), "run_id": F.lit("seed")})
    horizon, newest = index.agg(F.max("ingested"), F.date_format(F.max("ingested"), "yyyy-MM-dd'T'HH:mm:ss")).first()
    missed = listed.join(index.select(F.col("file").alias("name")), "name", "left_anti")
    empty = {name: spark.createDataFrame([], struct(ddl)) for name, ddl in STATE.items()}
    tables = empty | {
        "file_index": entries,
        "file_months": census.rolled(spark, out, "file_counts"),
        "cells_base": cells.groupBy("provider", "coll_month", "h3_r9").agg(*summed()),
        "vdays_base": census.rolled(spark, out, "vdays_r8"),
        "pending": missed.where(parse_stamp(F.col("name")) <= F.lit(horizon)).select("key", "etag", at.alias("seen_at")),
    }
    ledger.commit(tables, **{NEWEST: newest})
    listed.unpersist()
    return ledger.number


CHUNK = 15_000


def seed_underway(spark: SparkSession, ledger: Ledger, cache: str, archive: Archive, chunk: int = CHUNK) -> dict[str, int]:
    """Minutes of live groups that hold readings of their own: cached by chunk of files, so that a broken run goes on.

    Files are dealt to chunks by a hash of their names. Minutes of files that are no longer live are left out.
    """
    ensure(spark)
    files = Files(spark)
    index = ledger.read("file_index")
    keep = tracks.keep_groups(index).persist()

    def done(what: str) -> list[str]:
        """Chunks whose list of files, which is written last, is complete."""
        return [f"{cache}/{name}/{what}" for name in sorted(files.names(cache)) if census.complete(files, f"{cache}/{name}/files")]

    wanted = index.join(keep, ["file", "unique_id"], "left_semi").where("key IS NOT NULL").select("file", "key", "size", "etag").distinct()
    if done("files"):
        wanted = wanted.join(spark.read.schema("file string").parquet(*done("files")), "file", "left_anti")
    wanted = wanted.persist()
    todo = wanted.count()
    parts = -(-todo // chunk)
    for k in range(parts):
        part, where = wanted.where(F.pmod(F.xxhash64("file"), F.lit(parts)) == k), f"{cache}/{uuid.uuid4().hex}"
        tracks.minutes(keyed(archive.published(spark, part)), keep).write.option("compression", "zstd").parquet(f"{where}/minutes")
        part.select("file").write.parquet(f"{where}/files")
    minutes = spark.read.parquet(*done("minutes")) if done("minutes") else tracks.minutes(keyed(archive.published(spark, wanted)), keep)
    base = tracks.underway(minutes.join(keep.withColumnRenamed("unique_id", "platform"), ["file", "platform"], "left_semi"))
    # All live files are in the base now, so the deltas begin anew.
    ledger.commit({"uw_base": base, "uw_delta": spark.createDataFrame([], struct(STATE["uw_delta"]))})
    for df in (keep, wanted):
        df.unpersist()
    return {"files_read": todo, "chunks": len(done("files"))}
