"""The full census: keyed readings are staged batch by batch, all are classified in one plan, the roll-ups are written.

What is done shows in what is there: a batch counts once its readings' folder is marked complete by Spark, a census once
all its roll-ups are. Staging anything drops the census that it makes stale.
"""

from __future__ import annotations

from datetime import datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomline.functions.schema import conform
from fathomline.operators import rollup
from fathomline.operators.classify import classify
from fathomline.operators.recent import moment
from fathomline.plans.work import together
from fathomline.session import ensure
from fathomline.sources.files import Files
from fathomline.sources.readings import KEYED

ROLLUPS = {"file_counts": rollup.file_month_counts, "daily": rollup.daily, "cells_r9": rollup.month_cells, "vdays_r8": rollup.vessel_days}


def complete(files: Files, folder: str) -> bool:
    return "_SUCCESS" in files.names(folder)


def stage(spark: SparkSession, rows: DataFrame, out: str, batch: str) -> DataFrame:
    """Take in a batch of keyed readings; it replaces what was staged under its name, in every month.

    Returns files, rows and months of the batch, as one row.
    """
    ensure(spark)
    files = Files(spark)
    files.remove(f"{out}/census")
    rows = rows.persist()
    rollup.group_meta(rows).write.mode("overwrite").parquet(f"{out}/groups/batch={batch}")
    # The batch comes first in the path, so that staging it again drops months that it no longer has.
    rows.write.mode("overwrite").partitionBy("coll_month").option("partitionOverwriteMode", "static").parquet(f"{out}/readings/batch={batch}")
    rows.unpersist()
    written = spark.read.schema(KEYED).parquet(f"{out}/readings/batch={batch}")
    return written.agg(F.count_distinct("file").alias("files"), F.count("*").alias("rows"), F.array_sort(F.collect_set("coll_month")).alias("months"))


def batches(spark: SparkSession, out: str) -> list[str]:
    """Names of the batches that are staged as a whole."""
    files = Files(spark)
    found = (n.removeprefix("batch=") for n in files.names(f"{out}/readings"))
    return sorted(b for b in found if complete(files, f"{out}/readings/batch={b}"))


def staged(spark: SparkSession, out: str, before: datetime | None = None) -> DataFrame:
    here = batches(spark, out)
    if not here:
        return spark.createDataFrame([], KEYED)
    rows = conform(spark.read.schema(KEYED).option("basePath", f"{out}/readings").parquet(*(f"{out}/readings/batch={b}" for b in here)), KEYED)
    return rows if before is None else rows.where(F.col("ingested") < moment(before))


def rank(spark: SparkSession, out: str, before: datetime | None = None, dest: str | None = None) -> None:
    """Classify all staged readings, of all months at once, and write the roll-ups."""
    ensure(spark)
    classified = classify(staged(spark, out, before)).persist()

    def write(name: str) -> None:
        ROLLUPS[name](classified).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{dest or out}/census/{name}")

    # The first fills what is kept, the others read it side by side.
    first, *others = ROLLUPS
    write(first)
    together(spark, [partial(write, name) for name in others])
    classified.unpersist()


def ranked(spark: SparkSession, out: str) -> bool:
    files = Files(spark)
    return all(complete(files, f"{out}/census/{name}") for name in ROLLUPS)


def rolled(spark: SparkSession, out: str, name: str) -> DataFrame:
    """A roll-up of a census that is complete."""
    if not ranked(spark, out):
        raise FileNotFoundError(f"{out} holds no complete census: rank it")
    return spark.read.parquet(f"{out}/census/{name}")


def finalize(spark: SparkSession, out: str, before: datetime | None = None, dest: str | None = None) -> str:
    """The file index, metadata with counts, in order of ingest; returns where it is."""
    groups = spark.read.parquet(*(f"{out}/groups/batch={b}" for b in batches(spark, out)))
    groups = groups if before is None else groups.where(F.col("ingested") < moment(before))
    where = f"{dest or out}/census/file_index"
    rollup.finalize(groups, rolled(spark, dest or out, "file_counts")).write.mode("overwrite").parquet(where)
    return where
