"""Which copy of a reading is the original, and what the later copies are."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNIQUE, RESEND, CROSS = "unique", "dup_resend", "dup_cross_id"
ORDER = ("ingested", "file", "unique_id")


def tallies() -> list[Column]:
    """The four additive counts of classified readings."""
    return [F.count("*").alias("n_rows"), *(F.count_if(F.col("class") == c).alias(f"n_{c}") for c in (UNIQUE, RESEND, CROSS))]


def summed(sign: int = 1) -> list[Column]:
    """The same counts of rows that are tallied already."""
    return [(F.sum(n) * sign).cast("long").alias(n) for n in ("n_rows", "n_unique", "n_dup_resend", "n_dup_cross_id")]


def _label(first: Column, original_id: Column) -> Column:
    return F.when(first, F.lit(UNIQUE)).when(original_id == F.col("unique_id"), F.lit(RESEND)).otherwise(F.lit(CROSS))


def classify(df: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    """Adds `class`. The original of a key is its first row by `order`, nulls last; a null key is a key like others.

    The originals are found by an aggregate that combines before the shuffle, then joined back; a key that holds much of
    the table is never gathered in one task, as a window over keys would do.
    """
    ranks = [c for name in order for c in (F.col(name).isNull().alias(f"no_{name}"), F.col(name))]
    originals = df.groupBy("key").agg(F.min(F.struct(*ranks)).alias("_original")).withColumnRenamed("key", "_key")
    joined = df.join(originals, F.col("key").eqNullSafe(F.col("_key")))
    at_first = F.lit(True)
    for name in order:
        at_first = at_first & F.col(name).eqNullSafe(F.col(f"_original.{name}"))
    # Rows that repeat the original's own place: one of them is it. They lie in one file.
    twins = Window.partitionBy("key", *order).orderBy(*(c for c in df.columns if c not in ("key", *order)), "key")
    first = at_first & (F.row_number().over(twins) == 1)
    return joined.withColumn("class", _label(first, F.col("_original.unique_id"))).drop("_key", "_original")


def classify_by_window(df: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    """The same by one window over keys: one shuffle less, for data whose keys are known to repeat little."""
    rest = [c for c in df.columns if c not in ("key", *order)]
    over = Window.partitionBy("key").orderBy(*(F.asc_nulls_last(c) for c in order), *rest, "key").rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("class", _label(F.row_number().over(over) == 1, F.first("unique_id").over(over)))
