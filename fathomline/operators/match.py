"""What is new, what fits a budget, what repeats a whole file, and which files could hold originals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def new_objects(listed: DataFrame, index: DataFrame) -> DataFrame:
    """Listed (key, etag) that the index lacks; of several listings of a key the latest."""
    fresh = listed.join(index.select("key", "etag"), ["key", "etag"], "left_anti")
    latest = Window.partitionBy("key").orderBy(F.desc("last_modified"), "etag")
    return fresh.withColumn("_n", F.row_number().over(latest)).where("_n = 1").drop("_n")


def within_budget(df: DataFrame, order: list[str], size: str, max_rows: int, max_size: float) -> DataFrame:
    """The longest prefix by `order` within both limits, but at least one row.

    Rows are numbered and summed block by block: a range-partitioned sort, per-partition totals, then local running sums.
    Only the totals, one row for each partition, meet in one task.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_p", F.spark_partition_id())
    local = Window.partitionBy("_p").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    running = ranged.withColumns({"_n": F.count("*").over(local), "_s": F.sum(size).over(local)}).persist()
    totals = running.groupBy("_p").agg(F.max("_n").alias("n"), F.sum(size).alias("s"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offset = totals.select("_p", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"), F.coalesce(F.sum("s").over(before), F.lit(0)).alias("s0"))
    placed = running.join(F.broadcast(offset), "_p")  # one row for each partition
    number, total = F.col("_n") + F.col("n0"), F.col("_s") + F.col("s0")
    return placed.where((number == 1) | ((number <= max_rows) & (total <= max_size))).select(*df.columns)


def fingerprint_matches(new: DataFrame, index: DataFrame) -> DataFrame:
    """New groups that repeat a live group as a whole; the earliest such group."""
    live = index.where("status = 'live'").select(F.col("file").alias("dup_of"), F.col("unique_id").alias("dup_uid"), "fingerprint", "n_rows", F.col("ingested").alias("_seen"))
    earliest = Window.partitionBy("file", "unique_id").orderBy(F.asc_nulls_last("_seen"), "dup_of", "dup_uid")
    found = new.select("file", "unique_id", "fingerprint", "n_rows").join(live, ["fingerprint", "n_rows"])
    return found.withColumn("_n", F.row_number().over(earliest)).where("_n = 1").select("file", "unique_id", "dup_of", "dup_uid")


def overlapping(new: DataFrame, index: DataFrame) -> DataFrame:
    """Index rows of the same provider that overlap a new group in time and in its bounding box.

    Providers are few and large, so both sides are dealt by (provider, month of time) instead: a side that spans several
    months stands in each. Times compare as text.
    """
    month = lambda c: F.coalesce(F.try_to_timestamp(F.left(c, F.lit(7)), F.lit("yyyy-MM")), F.lit(None).cast("timestamp"))
    # A text that is no date falls into a block that meets all others of its provider.
    blocks = lambda: F.when(month("t_min").isNotNull() & month("t_max").isNotNull() & (month("t_min") <= month("t_max")), F.transform(F.sequence(month("t_min"), month("t_max"), F.expr("interval 1 month")), lambda t: F.date_format(t, "yyyy-MM")))
    left = new.select("provider", "t_min", "t_max", "lon_min", "lon_max", "lat_min", "lat_max").withColumn("blocks", blocks())
    right = index.where("status = 'live' AND n_unique > 0 AND key IS NOT NULL").withColumn("blocks", blocks())
    a = left.select(*(F.col(c).alias(f"n_{c}") for c in left.columns))
    meets = (
        (F.col("t_min") <= F.col("n_t_max")) & (F.col("t_max") >= F.col("n_t_min")) & (F.col("lon_min") <= F.col("n_lon_max")) & (F.col("lon_max") >= F.col("n_lon_min"))
        & (F.col("lat_min") <= F.col("n_lat_max")) & (F.col("lat_max") >= F.col("n_lat_min")) & (F.col("provider") == F.col("n_provider"))
    )
    dated_a, dated_b = a.where("n_blocks IS NOT NULL"), right.where("blocks IS NOT NULL")
    exploded_a, exploded_b = dated_a.withColumn("n_block", F.explode("n_blocks")), dated_b.withColumn("block", F.explode("blocks"))
    # Only whether a partner exists matters: semi joins make no pairs.
    out = exploded_b.join(exploded_a, (F.col("block") == F.col("n_block")) & meets, "left_semi").select(*index.columns).distinct()
    undated = a.where("n_blocks IS NULL")
    odd_a = dated_b.join(undated, meets, "left_semi").select(*index.columns)
    odd_b = right.where("blocks IS NULL").join(a, meets, "left_semi").select(*index.columns)
    return out.unionByName(odd_a).distinct().unionByName(odd_b)
