"""Archives of published files, seen as two tables: what is listed, and the rows of listed files.

Listings and contents are DataFrames that executors make, so that an archive of millions of files never passes through
the driver. A folder on any file system is read by Spark's own readers. A public bucket that is reached by HTTP alone is
listed and read by tasks, each with one connection that it keeps.
"""

from __future__ import annotations

import http.client
import random
import time
import urllib.parse
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from datetime import date, datetime
from typing import Protocol
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomline.functions.schema import PUBLISHED, struct
from fathomline.sources.files import Files

LISTING = "key string, name string, size long, etag string, last_modified timestamp"
#: Where published files lie below an archive's root, if the caller names no other place; below it year/month/day.
PLACE = "csb/csv/"


class Archive(Protocol):
    def listing(self, spark: SparkSession, days: Sequence[date] | None = None) -> DataFrame:
        """LISTING of the files of some days of publication, or of all."""

    def published(self, spark: SparkSession, objects: DataFrame) -> DataFrame:
        """file and the PUBLISHED columns, as text, of listed objects (key, size, etag)."""


def day_of(key: Column) -> Column:
    """The day of publication in a key: three folders of digits before the name."""
    found = F.regexp_extract(key, r"(?:^|/)(\d{4}/\d{2}/\d{2})/[^/]*$", 1)
    return F.to_date(F.try_to_timestamp(found, F.lit("yyyy/MM/dd")))


def named(df: DataFrame) -> DataFrame:
    return df.select("key", F.element_at(F.split("key", "/"), -1).alias("name"), "size", "etag", "last_modified")


@dataclass(frozen=True)
class Folder:
    """A folder on any file system. A file's tag is made of its size and its time."""

    root: str
    place: str = PLACE

    def _at(self, day: date | None = None) -> str:
        return "/".join(filter(None, (self.root.rstrip("/"), self.place.strip("/"), f"{day:%Y/%m/%d}" if day else "")))

    def listing(self, spark: SparkSession, days: Sequence[date] | None = None) -> DataFrame:
        files = Files(spark)
        where = [p for p in ([self._at()] if days is None else map(self._at, days)) if files.exists(p)]
        if not where:
            return spark.createDataFrame([], LISTING)
        top = len(files.qualified(self.root)) + 1
        # Without its content column this reader only lists, in parallel where there are many folders.
        found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").load(where)
        tag = F.concat_ws("-", F.hex("length"), F.hex(F.unix_micros("modificationTime")))
        return named(found.select(F.expr(f"substring(path, {top + 1})").alias("key"), F.col("length").alias("size"), tag.alias("etag"), F.col("modificationTime").alias("last_modified")))

    def published(self, spark: SparkSession, objects: DataFrame) -> DataFrame:
        keys = [r["key"] for r in objects.select("key").distinct().collect()]  # the caller bounds what is read at once
        if not keys:
            return spark.createDataFrame([], f"{PUBLISHED}, file string")
        reader = spark.read.schema(struct(PUBLISHED)).option("header", True).option("enforceSchema", False).option("mode", "FAILFAST").option("escape", '"')
        return reader.csv([f"{self.root.rstrip('/')}/{k}" for k in keys]).withColumn("file", F.col("_metadata.file_name"))


@dataclass(frozen=True)
class AsOf:
    """Another archive as it stood at a moment."""

    inner: Archive
    moment: datetime

    def listing(self, spark: SparkSession, days: Sequence[date] | None = None) -> DataFrame:
        return self.inner.listing(spark, days).where(F.unix_micros("last_modified") <= int(self.moment.timestamp() * 1_000_000))

    def published(self, spark: SparkSession, objects: DataFrame) -> DataFrame:
        return self.inner.published(spark, objects)


@dataclass(frozen=True)
class Tables:
    """An archive that is two tables already."""

    listed: DataFrame
    rows: DataFrame

    def listing(self, spark: SparkSession, days: Sequence[date] | None = None) -> DataFrame:
        return self.listed if days is None else self.listed.where(day_of(F.col("key")).isin(list(days)))

    def published(self, spark: SparkSession, objects: DataFrame) -> DataFrame:
        wanted = objects.select(F.element_at(F.split("key", "/"), -1).alias("file")).distinct()
        return self.rows.join(wanted, "file", "left_semi")


# A bucket that is reached by HTTP alone.


class Refused(Exception):
    """The server understood and will not do it: asking again is no use."""


class Connection:
    """One connection that is kept from request to request, and made anew after a fault."""

    #: Seconds before the second to the last attempt.
    PAUSES = (0.5, 2.0, 8.0, 30.0)

    def __init__(self, host: str, timeout: float = 60.0, connect: Callable[..., http.client.HTTPConnection] = http.client.HTTPSConnection, sleep: Callable[[float], None] = time.sleep) -> None:
        self.make, self.sleep = (lambda: connect(host, timeout=timeout)), sleep
        self.open: http.client.HTTPConnection | None = None

    def get(self, target: str, size: int | None = None) -> bytes:
        """The body of an answer, of `size` bytes if that is known. Faults of the network or the server are waited out."""
        pauses = iter(self.PAUSES)
        while True:
            try:
                return self._once(target, size)
            except (OSError, http.client.HTTPException):
                self.open = None
                if (pause := next(pauses, None)) is None:
                    raise
                self.sleep(pause * random.uniform(0.5, 1.5))

    def _once(self, target: str, size: int | None) -> bytes:
        self.open = self.open or self.make()
        self.open.request("GET", target)
        answer = self.open.getresponse()
        body = answer.read()
        if answer.status // 100 == 4:
            raise Refused(f"{answer.status} {target}")
        if answer.status != 200 or size not in (None, len(body)):
            raise ConnectionError(f"status {answer.status}, {len(body)} bytes of {size}: {target}")
        return body


def listing_page(body: bytes) -> tuple[list[dict[str, str]], str | None]:
    """The entries of a page of a bucket's listing, version 2, and the token of the next page."""
    entries: list[dict[str, str]] = []
    rest: dict[str, str] = {}
    for node in ElementTree.fromstring(body):
        kind = node.tag.rpartition("}")[2]
        if kind == "Contents":
            entries.append({child.tag.rpartition("}")[2]: child.text or "" for child in node})
        else:
            rest[kind] = node.text or ""
    return entries, rest.get("NextContinuationToken") if rest.get("IsTruncated") == "true" else None


def listed_below(get: Callable[[str], bytes], prefix: str) -> Iterator[dict[str, list]]:
    """Columns of LISTING, page by page, of the CSV files below a prefix."""
    token: str | None = None
    while True:
        asked = {"list-type": "2", "prefix": prefix, **({"continuation-token": token} if token else {})}
        entries, token = listing_page(get("/?" + urllib.parse.urlencode(asked)))
        rows = [e for e in entries if e["Key"].endswith(".csv")]
        yield {"key": [e["Key"] for e in rows], "size": [int(e["Size"]) for e in rows], "etag": [e["ETag"].strip('"') for e in rows], "last_modified": [e["LastModified"] for e in rows]}
        if token is None:
            return


@dataclass(frozen=True)
class Bucket:
    """A public bucket. What was fetched once is kept in `cache`, a folder that executors share, so that a broken run goes on."""

    host: str
    cache: str
    place: str = PLACE
    tasks: int = 16

    def listing(self, spark: SparkSession, days: Sequence[date] | None = None) -> DataFrame:
        host = self.host

        def pages(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            connection = Connection(host)
            for part in parts:
                for prefix in part.column("prefix").to_pylist():
                    for columns in listed_below(connection.get, prefix):
                        yield pa.RecordBatch.from_pydict(columns, schema=pa.schema([("key", pa.string()), ("size", pa.int64()), ("etag", pa.string()), ("last_modified", pa.string())]))

        prefixes = [self.place] if days is None else [f"{self.place}{d:%Y/%m/%d}/" for d in days]
        asked = spark.createDataFrame([(p,) for p in prefixes], "prefix string").repartition(min(self.tasks, max(1, len(prefixes))))
        found = asked.mapInArrow(pages, "key string, size long, etag string, last_modified string")
        return named(found.withColumn("last_modified", F.to_timestamp("last_modified")))

    def published(self, spark: SparkSession, objects: DataFrame) -> DataFrame:
        host, kept = self.host, "key string, etag string, content binary"

        def fetch(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            connection = Connection(host)
            for part in parts:
                for row in part.to_pylist():
                    body = connection.get("/" + urllib.parse.quote(row["key"]), row["size"])
                    yield pa.RecordBatch.from_pydict({"key": [row["key"]], "etag": [row["etag"]], "content": [body]}, schema=pa.schema([("key", pa.string()), ("etag", pa.string()), ("content", pa.binary())]))

        wanted = objects.select("key", "size", "etag").distinct()
        here = spark.read.schema(kept).parquet(self.cache) if Files(spark).exists(self.cache) else spark.createDataFrame([], kept)
        missing = wanted.join(here.select("key", "etag"), ["key", "etag"], "left_anti").repartition(self.tasks)
        missing.mapInArrow(fetch, kept).write.mode("append").parquet(self.cache)
        content = spark.read.schema(kept).parquet(self.cache).join(wanted.select("key", "etag"), ["key", "etag"], "left_semi").dropDuplicates(["key", "etag"])
        return parsed(content)


def parsed(content: DataFrame) -> DataFrame:
    """file and the PUBLISHED columns of whole files (key, content). A file with another header is an error."""
    lines = F.split(F.decode("content", "UTF-8"), "\r?\n")
    header = ",".join(struct(PUBLISHED).names)
    checked = F.when(lines[0] == header, F.slice(lines, F.lit(2), F.size(lines))).otherwise(F.raise_error(F.concat(F.lit("unexpected header in "), F.col("key"))).cast("array<string>"))
    rows = content.select(F.element_at(F.split("key", "/"), -1).alias("file"), F.explode(checked).alias("line")).where("line <> ''")
    return rows.select(F.from_csv("line", PUBLISHED, {"mode": "FAILFAST", "escape": '"'}).alias("row"), "file").select("row.*", "file")
