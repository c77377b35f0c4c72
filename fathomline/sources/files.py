"""Small files and folders on any file system that Spark reaches: local, HDFS, object stores."""

from __future__ import annotations

import json
import uuid
from typing import Any

from pyspark.sql import SparkSession


class Files:
    """Hadoop's file systems, for what is not a table: documents, logs, what a folder holds."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self._hadoop = spark, spark._jvm.org.apache.hadoop.fs

    def _open(self, path: str):
        at = self._hadoop.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def qualified(self, path: str) -> str:
        """The path as Spark's readers report it."""
        system, at = self._open(path)
        return system.makeQualified(at).toString()

    def exists(self, path: str) -> bool:
        system, at = self._open(path)
        return system.exists(at)

    def names(self, path: str) -> dict[str, int]:
        """What lies directly in a folder, with its size; folders have -1. A folder that is not there holds nothing."""
        system, at = self._open(path)
        if not system.exists(at):
            return {}
        return {s.getPath().getName(): -1 if s.isDirectory() else s.getLen() for s in system.listStatus(at)}

    def read(self, path: str) -> str:
        system, at = self._open(path)
        stream = system.open(at)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        """Create a file, or replace it."""
        system, at = self._open(path)
        stream = system.create(at, True)
        try:
            stream.write(text.encode())
        finally:
            stream.close()

    def claim(self, path: str, text: str) -> bool:
        """Create a file in one step, whole or not at all; False if somebody was first."""
        passing = f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}"
        self.write(passing, text)
        context = self._hadoop.FileContext.getFileContext(self._hadoop.Path(path).toUri(), self.spark._jsc.hadoopConfiguration()) if "://" in path else self._hadoop.FileContext.getFileContext(self.spark._jsc.hadoopConfiguration())
        none = self.spark.sparkContext._gateway.new_array(getattr(self._hadoop, "Options$Rename"), 0)
        try:
            if self.exists(path):
                return False
            context.rename(self._hadoop.Path(passing), self._hadoop.Path(path), none)
            return True
        except Exception:
            if self.exists(path):
                return False
            raise
        finally:
            self.remove(passing)

    def remove(self, path: str) -> None:
        system, at = self._open(path)
        system.delete(at, True)

    def move(self, path: str, to: str) -> None:
        system, at = self._open(path)
        system.rename(at, self._hadoop.Path(to))

    def save(self, path: str, doc: Any) -> None:
        self.write(path, json.dumps(doc, separators=(",", ":")))
