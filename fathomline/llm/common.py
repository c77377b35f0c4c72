"""What several of the training-data operators share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Folds used by the learned operators: rows of fold 0 are held out.
FOLDS = 5

#: Rows and bytes of one Arrow batch that is handed to a Python worker: whole texts travel, so batches are kept short.
BATCH_ROWS, BATCH_BYTES = 200, 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column) -> Column:
    """crc32 of the id's text modulo FOLDS; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS


def held_out(doc_id: Column) -> Column:
    return fold(doc_id) == 0


def batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session, so that a worker holds a few whole texts at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


@contextmanager
def batch_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of so many rows for what is computed meanwhile: the setting is read when a plan runs."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def ensure_checkpoints(spark: SparkSession) -> None:
    """Use the cluster's shared checkpoint folder. Only a session on one machine gets a folder of its own where none is set."""
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not context.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    context.setCheckpointDir(configured or tempfile.mkdtemp(prefix="fathomline-checkpoints-"))


def cut(df: DataFrame) -> DataFrame:
    """Compute once and cut the lineage, in files that outlive any executor."""
    ensure_checkpoints(df.sparkSession)
    return df.checkpoint(eager=True)


def keep(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> DataFrame:
    """Compute once, when first read. Parts that go with an executor are computed again from the lineage."""
    return df.persist(level)


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, most: int) -> DataFrame:
    """rows joined with groups, a row for each key, whose column `size` says how many rows have it.

    Groups of more than 1/most of all rows are broadcast: there cannot be more than `most` of them, and no task gathers
    one. The others are joined by shuffling, unless all groups are as few.
    """
    row = groups.agg(F.sum(size).alias("rows"), F.count("*").alias("groups")).first()
    if row["groups"] <= most:
        return rows.join(F.broadcast(groups), keys)
    large = F.col(size) > row["rows"] / most
    marked = rows.join(F.broadcast(groups.where(large).withColumn("_large", F.lit(1))), keys, "left")
    rest = marked.where("_large is null").select(*rows.columns).join(groups.where(~large), keys)
    found = marked.where("_large is not null").drop("_large")
    return found.unionByName(rest)


def hash128(value: Column) -> list[Column]:
    """Two independent 64-bit hashes: together they tell texts apart at any corpus size met in practice."""
    return [F.xxhash64(value), F.xxhash64(F.lit(7), value)]


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the driver and all executors share."""
    ensure_checkpoints(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


class Scratch:
    """A folder of one piece of work, in the shared folder. Tables stored here are computed once, outlive any executor,
    and are read back with the plan of one scan, however they were made. All go when the work ends."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.path, self.stored = spark, shared_path(spark, name), 0

    def store(self, df: DataFrame) -> DataFrame:
        path = f"{self.path}/{self.stored}"
        self.stored += 1
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def append(self, df: DataFrame, name: str) -> DataFrame:
        """Add rows to a named table; all its rows so far."""
        df.write.mode("append").parquet(f"{self.path}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{name}")

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *failure: object) -> None:
        remove(self.spark, self.path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder through the file system that it lies in."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def release() -> None:
    """Give memory that a finished piece of work has freed back to the system: workers and drivers live long."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # a C library without it
        pass
