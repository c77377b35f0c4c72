"""Session construction: settings that results depend on, and settings that only speed depends on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Results depend on these.
SEMANTIC = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# Only speed depends on these.
TUNING = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def session(master: str | None = None, app: str = "fathomline", **conf: str) -> SparkSession:
    """Build (or reuse) a session. Extra settings are given with dots written as double underscores."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        cores = master[6:-1] if master.startswith("local[") else ""
        n = os.cpu_count() or 8 if cores in ("", "*") else int(cores)
        builder = builder.config("spark.sql.shuffle.partitions", str(max(n, 4)))
    for key, value in (SEMANTIC | TUNING).items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def ensure(spark: SparkSession) -> SparkSession:
    """Apply the result-defining settings to a session that somebody else built."""
    for key, value in SEMANTIC.items():
        spark.conf.set(key, value)
    return spark
