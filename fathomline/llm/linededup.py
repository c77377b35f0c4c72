"""Line dedup over levelled sorted runs of line hashes.

A run is a table of line hashes with the number of documents that hold the line, hash-bucketed and sorted, so that runs
are merged bucket by bucket. A new batch of counted lines merge-anti-joins the runs for the lines that some run already
knows to be common (nothing more need be known of those), and adds the rest as a run of level 0. When a level has FAN
runs, they are compacted into one of the next level, summing counts. The common lines of all batches are those whose
counts over all runs reach the threshold. A whole table is hashed once and dealt into BATCHES batches.

A line's key is the line without ASCII white space at its ends and with A-Z lower-cased; a key has at least MIN_KEY code
points, else its lines always stay. Hashes are 128 bits. Up to BROADCAST_LINES common lines, the most common ones, go to
the tasks as two sorted arrays (16 bytes a line), and each document is rewritten where it is read; what there is beyond
that number is joined with the documents' lines first, and as the most common lines are not among it, no line is held by
more than one in BROADCAST_LINES of all.

Defined cases: a null or empty text is one empty line, and its kept text is empty; rows that repeat an id are one
document where documents are counted (a line counts once for it), and are rewritten each; rows with a null id are
documents of their own; an empty table gives none. All columns of the input stay but n_lines and n_dropped, which are
replaced, and the text.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomline.llm.common import batches, cut, hash128, keep, release, remove, shared_path, table

#: Documents that must hold a line, shortest key in code points, runs of a level that are compacted, batches of a table.
THRESHOLD, MIN_KEY, FAN, BATCHES = 10, 1, 2, 3
#: Lines of a bucket, counted over all batches: a counted line is a few bytes, so runs have few, large files.
PER_BUCKET = 250_000
#: Common lines that are broadcast at most.
BROADCAST_LINES = 1_000_000

SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LOWERED = bytes.maketrans(UPPER.encode(), LOWER.encode())


def key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(SPACE)), UPPER, LOWER)


def keys(docs: DataFrame, text_col: str = "text", *carried: str) -> DataFrame:
    """(*carried, h1, h2): one row for each row and distinct line key in it."""
    lines = F.split(F.translate(F.coalesce(F.col(text_col), F.lit("")), UPPER, LOWER), "\n", -1)
    distinct = F.array_distinct(F.transform(lines, lambda x: F.btrim(x, F.lit(SPACE))))
    line = docs.select(*carried, F.explode(distinct).alias("line")).where(F.length("line") >= MIN_KEY)
    h1, h2 = hash128(F.col("line"))
    return line.select(*carried, h1.alias("h1"), h2.alias("h2"))


def counted_keys(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", parts: int = 1) -> DataFrame:
    """(part, h1, h2, n): in how many documents of a part each line stands. Texts are dealt to parts by their hash."""
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.pmod(F.xxhash64(text_col), F.lit(parts)).cast("int").alias("part"))
    twice = keep(rows.where(F.col("_id").isNotNull()).groupBy("_id").count().where("count > 1").select("_id"))
    if twice.isEmpty():
        found = keys(rows, "_text", "part")
    else:  # lines of rows with one id count once
        same = keys(rows.join(twice, "_id", "left_semi"), "_text", "_id", "part").groupBy("_id", "h1", "h2").agg(F.min("part").alias("part"))
        found = keys(rows.join(twice, "_id", "left_anti"), "_text", "part").unionByName(same.drop("_id"))
    return found.groupBy("part", "h1", "h2").agg(F.count("*").alias("n"))


class LineRuns:
    """The levelled runs of one store, as bucketed tables in the shared folder."""

    def __init__(self, spark: SparkSession, threshold: int = THRESHOLD, fan: int = FAN, buckets: int = 2) -> None:
        self.spark, self.threshold, self.fan, self.buckets = spark, threshold, fan, buckets
        self.runs: list[tuple[int, str, str]] = []  # level, table, path

    def _write(self, counted: DataFrame, level: int) -> None:
        name, path = f"line_run_{uuid.uuid4().hex}", shared_path(self.spark, "line-run")
        dealt = counted.repartition(self.buckets, "h1", "h2").sortWithinPartitions("h1", "h2")
        dealt.write.bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2").option("path", path).saveAsTable(name)
        self.runs.append((level, name, path))

    def _drop(self, run: tuple[int, str, str]) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {run[1]}")
        remove(self.spark, run[2])
        self.runs.remove(run)

    def _sum(self, runs: list[tuple[int, str, str]]) -> DataFrame:
        """Runs merged by full merge joins, which find their buckets in place."""
        whole = self.spark.table(runs[0][1])
        for _, name, _ in runs[1:]:
            more = self.spark.table(name).withColumnRenamed("n", "more")
            total = F.coalesce("n", F.lit(0)) + F.coalesce("more", F.lit(0))
            whole = whole.join(more, ["h1", "h2"], "full").select("h1", "h2", total.alias("n"))
        return whole

    def add(self, counted: DataFrame) -> None:
        """Take in a batch (h1, h2, n): anti-join what is settled, add a run, compact full levels."""
        for _, name, _ in self.runs:
            settled = self.spark.table(name).where(F.col("n") >= self.threshold).select("h1", "h2")
            counted = counted.join(settled, ["h1", "h2"], "left_anti")
        self._write(counted, 0)
        level = 0
        while len(full := [r for r in self.runs if r[0] == level]) >= self.fan:
            self._write(self._sum(full), level + 1)
            for run in full:
                self._drop(run)
            level += 1

    def common(self) -> DataFrame:
        """(h1, h2, n) of the lines that reach the threshold; it reads the runs."""
        if not self.runs:
            return self.spark.createDataFrame([], "h1 long, h2 long, n long")
        return self._sum(self.runs).where(F.col("n") >= self.threshold)

    def close(self) -> None:
        for run in list(self.runs):
            self._drop(run)

    def __enter__(self) -> LineRuns:
        return self

    def __exit__(self, *failure: object) -> None:
        self.close()


def _rewriter(shared, seeds: tuple[int, int], names: list[str], at: int):
    import xxhash

    def among(lows: list[bytes]) -> np.ndarray:
        """Whether each key is a common line."""
        first, second = shared.value
        h = np.fromiter((xxhash.xxh64_intdigest(low, seeds[0]) for low in lows), np.uint64, len(lows))
        place = np.searchsorted(first, h)
        out = np.zeros(len(lows), bool)
        for k in np.flatnonzero((first[np.minimum(place, len(first) - 1)] == h) if len(first) else out):
            i, low = place[k], lows[k]
            h2 = np.uint64(xxhash.xxh64_intdigest(low, seeds[1])) if len(low) else None
            while h2 is not None and i < len(first) and first[i] == h[k] and not out[k]:
                out[k] = second[i] == h2
                i += 1
        return out

    def rewrite(texts: list[bytes]) -> Iterator[tuple[bytes, int, int]]:
        split = [(t.split(b"\n"), t.translate(_LOWERED).split(b"\n")) for t in texts]
        gone, start = among([low.strip(b" \t\n\x0b\x0c\r") for _, lows in split for low in lows]), 0
        for text, (lines, _) in zip(texts, split, strict=True):
            here = gone[start : start + len(lines)]
            start += len(lines)
            dropped = int(here.sum())
            yield (b"\n".join(line for line, out in zip(lines, here, strict=True) if not out) if dropped else text), len(lines), dropped

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            done = list(rewrite([t or b"" for t in part.column(at).cast(pa.binary()).to_pylist()]))
            columns = [*part.columns, *(pa.array([d[k] for d in done], pa.int64()) for k in (1, 2))]
            columns[at] = pa.array([d[0] for d in done], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "n_lines", "n_dropped"])
        release()

    return run


def drop_lines(docs: DataFrame, common: DataFrame, text_col: str = "text") -> DataFrame:
    """docs without the common lines (h1, h2, n); with n_lines and n_dropped."""
    spark = docs.sparkSession
    batches(spark)
    docs = docs.drop("n_lines", "n_dropped")
    row = common.agg(F.count("*").alias("lines"), F.sum("n").alias("n")).first()
    if row["lines"] > BROADCAST_LINES:
        # Not more than BROADCAST_LINES lines can each have more than that part of all.
        top = F.col("n") > row["n"] / max(1, BROADCAST_LINES)
        before = _drop_by_join(docs, common.where(~top), text_col).withColumnsRenamed({"n_lines": "_lines", "n_dropped": "_dropped"})
        after = drop_lines(before, common.where(top), text_col).withColumns({"n_lines": F.col("_lines"), "n_dropped": F.col("n_dropped") + F.col("_dropped")})
        return after.drop("_lines", "_dropped")
    held = common.select("h1", "h2").toArrow()  # BROADCAST_LINES rows at most
    first, second = (held.column(k).to_numpy().view(np.uint64) for k in (0, 1))
    order = np.argsort(first, kind="stable")
    # The second hash starts from the hash of its salt, the first from the function's own seed.
    salt = spark.range(1).select(F.xxhash64(F.lit(7))).first()[0] & ((1 << 64) - 1)
    schema = docs.withColumns({text_col: F.col(text_col).cast("string"), "n_lines": F.lit(0).cast("long"), "n_dropped": F.lit(0).cast("long")}).schema
    shared = spark.sparkContext.broadcast((first[order], second[order]))
    return docs.mapInArrow(_rewriter(shared, (42, salt), docs.columns, docs.columns.index(text_col)), schema)


def _drop_by_join(docs: DataFrame, common: DataFrame, text_col: str) -> DataFrame:
    """The same where the common lines are too many to hand to each task."""
    tagged = docs.withColumn("_text", F.coalesce(F.col(text_col), F.lit(""))).withColumn("_sha", F.sha2("_text", 256))
    pair = lambda x: F.struct(*(h.alias(n) for n, h in zip(("h1", "h2"), hash128(key(x)), strict=True)))
    lines = tagged.select("_sha", F.explode(F.array_distinct(F.transform(F.split("_text", "\n", -1), lambda x: key(x)))).alias("line"))
    h1, h2 = hash128(F.col("line"))
    # Texts that are equal lose the same lines, so hits are gathered by the text's own hash: one row for each.
    hits = lines.where(F.length("line") >= MIN_KEY).select(F.col("_sha").alias("_hit"), h1.alias("h1"), h2.alias("h2")).join(common, ["h1", "h2"])
    by_text = hits.groupBy("_hit").agg(F.collect_set(F.struct("h1", "h2")).alias("_common"))
    joined = tagged.join(by_text, F.col("_sha") == F.col("_hit"), "left")
    none = F.array().cast("array<struct<h1:bigint,h2:bigint>>")
    split = F.split("_text", "\n", -1)
    kept = F.filter(split, lambda x: (F.length(key(x)) < MIN_KEY) | ~F.array_contains(F.coalesce(F.col("_common"), none), pair(x)))
    made = joined.withColumns({"n_lines": F.size(split).cast("long"), "_kept": kept}).withColumn("n_dropped", F.col("n_lines") - F.size("_kept"))
    return made.withColumn(text_col, F.array_join("_kept", "\n")).select(*docs.columns, "n_lines", "n_dropped")


def dedupe(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", threshold: int = THRESHOLD, parts: int = BATCHES) -> DataFrame:
    """Whole-table dedup: the counted lines arrive in `parts` batches, then the documents lose every common line."""
    spark = docs.sparkSession
    counted = keep(counted_keys(docs, text_col, id_col, parts))
    try:
        with LineRuns(spark, threshold, buckets=max(2, -(-counted.count() // PER_BUCKET))) as runs:
            for k in range(parts):
                runs.add(counted.where(F.col("part") == k).drop("part"))
            common = cut(runs.common())
    finally:
        counted.unpersist()
    return drop_lines(docs, common, text_col)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedupe(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP4_SQL = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
  FROM documents
), keyed AS (
  SELECT doc_id, line, i, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS k FROM lines
), common AS (
  SELECT k FROM keyed WHERE length(k) >= {MIN_KEY} GROUP BY k HAVING count(DISTINCT doc_id) >= {THRESHOLD}
)
SELECT keyed.doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(common.k) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(CASE WHEN common.k IS NULL THEN line END, chr(10) ORDER BY i), '')) AS kept_sha256
FROM keyed LEFT JOIN common ON keyed.k = common.k GROUP BY keyed.doc_id
"""
