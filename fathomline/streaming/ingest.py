"""Structured Streaming: published files as a stream, classified batch by batch against what came before."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fathomline.functions.schema import PUBLISHED, struct
from fathomline.operators.classify import ORDER, classify
from fathomline.sources.files import Files
from fathomline.sources.readings import keyed


def read_stream(spark: SparkSession, folder: str, files_per_trigger: int | None = 1000, bytes_per_trigger: int | None = None) -> DataFrame:
    """A folder of published CSV files as a stream of keyed readings. A file that changes in place is not seen again:
    republished files are a matter of reconciliation."""
    reader = spark.readStream.schema(struct(PUBLISHED)).option("header", True).option("recursiveFileLookup", True)
    # A source takes one limit: bytes, if they are given, else files.
    reader = reader.option("maxBytesPerTrigger", bytes_per_trigger) if bytes_per_trigger else reader.option("maxFilesPerTrigger", files_per_trigger)
    return keyed(reader.csv(folder).withColumn("file", F.col("_metadata.file_name")))


def classify_batch(batch: DataFrame, batch_id: int, out: str) -> None:
    """Classify a batch behind the originals of earlier ones, and append its rows under its own number.

    Originals are kept apart, narrow, so that a batch reads no more of the past than keys and their order. Writing is
    idempotent: a batch that runs again after a failure replaces what it wrote, and reads only lower numbers.
    """
    spark = batch.sparkSession
    batch = batch.persist()
    earlier = [n for n in Files(spark).names(f"{out}/originals") if n.startswith("batch=") and int(n[6:]) < batch_id]
    rows = batch.withColumn("phase", F.lit(1))
    if earlier:
        originals = spark.read.parquet(*(f"{out}/originals/{n}" for n in earlier))
        held = originals.join(batch.select("key").distinct(), "key", "left_semi").withColumn("phase", F.lit(0))
        rows = held.unionByName(rows, allowMissingColumns=True)
    made = classify(rows, ("phase", *ORDER)).where("phase = 1").drop("phase").persist()
    made.write.mode("overwrite").parquet(f"{out}/classified/batch={batch_id}")
    made.where("class = 'unique'").select("key", *ORDER).write.mode("overwrite").parquet(f"{out}/originals/batch={batch_id}")
    made.unpersist()
    batch.unpersist()


def start(readings: DataFrame, out: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Run the stream: all that is there, or for ever."""
    writer = readings.writeStream.foreachBatch(lambda df, n: classify_batch(df, n, out)).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="6 hours")).start()


def windowed(readings: DataFrame, hours: int = 6) -> DataFrame:
    """Readings and platforms by ingest window and provider, counted exactly: a window's state holds its platforms' names.

    Late files are never dropped, so results are updates.
    """
    return readings.groupBy(F.window("ingested", f"{hours} hours"), "provider").agg(F.count("*").alias("n_rows"), F.size(F.collect_set("unique_id")).alias("platforms"))
