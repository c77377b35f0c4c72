"""Intermediate tables of one piece of work, in a folder that driver and executors share, and pieces done side by side."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession

from fathomline.sources.files import Files

#: Jobs that are submitted side by side: small ones, and the last tasks of large ones, leave cores free for each other.
AT_ONCE = 4


def together[T](spark: SparkSession, jobs: Sequence[Callable[[], T]]) -> list[T]:
    """Results of jobs that do not depend on each other, in their order. All have ended when one's failure is raised."""
    # Each job has a copy of its own of the thread's properties: Spark writes to them.
    with ThreadPoolExecutor(AT_ONCE) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]]


class Work:
    """Each table is computed once, survives executors, and is read back with the plan of one scan. All go in the end."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.path, self.kept = spark, f"{root}/work-{uuid.uuid4().hex}", 0

    def keep(self, df: DataFrame) -> DataFrame:
        self.kept += 1
        df.write.parquet(f"{self.path}/{self.kept}")
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{self.kept}")

    def measured(self, df: DataFrame, *aggregates: Column) -> tuple[DataFrame, Row]:
        """The same, with aggregates over its rows that are taken while they are written. Each needs a name of its own."""
        seen = Observation()
        kept = self.keep(df.observe(seen, *aggregates))
        return kept, Row(**seen.get)

    def __enter__(self) -> Work:
        return self

    def __exit__(self, *failure: object) -> None:
        Files(self.spark).remove(self.path)
