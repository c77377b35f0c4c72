"""Schemas of the published files, the keyed readings and the state tables, and how a table is made to fit one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

TALLIES = "n_rows long, n_unique long, n_dup_resend long, n_dup_cross_id long"
MINUTES = "min_underway long, min_slow long, min_stationary long, min_other long, n_soundings long"

# Names of the published columns and of the state tables' columns.
PUBLISHED = "UNIQUE_ID string, FILE_UUID string, LON string, LAT string, DEPTH string, TIME string, PLATFORM_NAME string, PROVIDER string"
STATE = {
    "file_index": f"file string, unique_id string, provider string, t_min string, t_max string, lon_min double, lon_max double, lat_min double, lat_max double, fingerprint decimal(20,0), ingested timestamp, {TALLIES}, key string, size long, etag string, status string, removed_at timestamp, method string, dup_of string, run_id string, published_at timestamp",
    "file_months": f"file string, unique_id string, coll_month string, {TALLIES}",
    "cells_base": f"provider string, coll_month string, h3_r9 long, {TALLIES}",
    "cells_delta": f"provider string, coll_month string, h3_r9 long, {TALLIES}, run_id string",
    "recent_cells": f"file string, unique_id string, provider string, ingested timestamp, coll_month string, day string, h3_r9 long, {TALLIES}",
    "vdays_base": f"provider string, platform string, day string, h3_r8 long, {TALLIES}",
    "vdays_delta": f"provider string, platform string, day string, h3_r8 long, {TALLIES}, run_id string",
    "uw_base": f"provider string, platform string, day string, h3_r8 long, {MINUTES}",
    "uw_delta": f"provider string, platform string, day string, h3_r8 long, {MINUTES}, file string, run_id string",
    "pending": "key string, etag string, seen_at timestamp",
    "queue": "provider string, coll_month string, reason string, queued_at timestamp",
    "runs": f"run_id string, kind string, run_at timestamp, generation long, new_files long, {TALLIES}, reread_bytes long, capped boolean, removed long, newest_published timestamp, finished_at timestamp",
}


def struct(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


def conform(df: DataFrame, ddl: str) -> DataFrame:
    """Columns by name, in order and typed; columns that are missing become null, others go."""
    here = set(df.columns)
    typed = ((f.name, f"`{f.name}`" if f.name in here else "NULL", f.dataType.simpleString()) for f in struct(ddl))
    return df.selectExpr(*(f"CAST({value} AS {kind}) AS `{name}`" for name, value, kind in typed))
