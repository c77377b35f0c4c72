"""Exact top-k search by integer inner product: tiled matrix products, partial selection per tile, tree merging.

Components are quantised to floor(scale * x), so scores are whole numbers and ties are exact. The stated queries are
packed into blocks of at most BLOCK_BYTES; one block after the other is broadcast (its size is bounded by that parameter)
and multiplied with every tile of the scan, which every core takes part in. A task keeps, for each query, the best k of
the tiles that it has seen and only looks at products that reach its worst; the tasks' short lists are merged in two
levels and stored. Neither the driver nor a task holds more than one block, however many queries there are, and a block
does so many products for each vector read that reading the vectors once for each block costs little beside them.

Defined cases: vectors that are null or hold null or non-finite components take no part, nor do null ids; an empty
vector scores 0 with other empty ones; rows that carry the query's id are its own and no candidates; repeated candidate
rows take a place each; of repeated query rows the smallest vector asks; a query is compared with vectors of its own
length; ties go to the smaller id; scores beyond a long are given as its largest or smallest value, in the order of the
true ones; columns other than the two named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fathomline.llm.common import Scratch, batch_rows, batches, cut, table

#: Bytes of one broadcast block of queries, rows of a tile, and tasks' lists that meet in the merge's first level.
BLOCK_BYTES, TILE_ROWS, MERGE_FAN = 16 << 20, 4096, 16
#: Products and sums below this are exact in float64; the ends of a long.
EXACT, LEAST, MOST = float(1 << 53), -(1 << 63), (1 << 63) - 1


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    x = F.col(vec_col).cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return vectors.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & ~bad).select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x"))


def matrices(part: pa.RecordBatch, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length of vector in a batch: ids, and quantised vectors as rows."""
    ids, vectors = part.column("vec_id").to_numpy(zero_copy_only=False), part.column("x")
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    flat, starts = vectors.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(lengths)])
    for n in np.unique(lengths):
        rows = np.flatnonzero(lengths == n)
        yield ids[rows], np.floor(scale * flat[starts[rows][:, None] + np.arange(n)])


def products(queries: np.ndarray, tile: np.ndarray) -> np.ndarray:
    """Exact inner products; through Python's integers where float64 could round."""
    if np.abs(queries).max(initial=0) * np.abs(tile).max(initial=0) * tile.shape[1] < EXACT:
        return queries @ tile.T
    whole = lambda a: np.array([[int(v) for v in row] for row in a], dtype=object)
    return whole(queries).dot(whole(tile).T)


def best(query: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Positions of each query's k best: larger score, then smaller id."""
    order = np.lexsort((ids, -score, query))
    first = np.flatnonzero(np.r_[True, np.diff(query[order]) != 0]) if len(order) else np.zeros(0, int)
    place = np.arange(len(order)) - np.repeat(first, np.diff(np.r_[first, len(order)]))
    return order[place < k]


class Running:
    """The best k so far for the queries of one length."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int) -> None:
        self.ids, self.vectors, self.k = ids, vectors, k
        self.cut = np.full(len(ids), -np.inf)
        self.query, self.found, self.score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)

    def tile(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        got = products(self.vectors, vectors)
        own = self.ids[:, None] == ids[None, :]
        if got.shape[1] >= self.k and np.isneginf(self.cut).any() and got.dtype != object:
            got[own] = -np.inf  # however many rows are its own, k others reach the cut, or there is none
            self.cut = np.maximum(self.cut, np.partition(got, -self.k, axis=1)[:, -self.k])
        q, c = np.nonzero((got >= self.cut[:, None]) & ~own)
        query, found, score = np.r_[self.query, q], np.r_[self.found, ids[c]], np.r_[self.score, got[q, c]]
        keep = best(query, found, score, self.k)
        self.query, self.found, self.score = query[keep], found[keep], score[keep]
        full = np.bincount(self.query, minlength=len(self.ids)) >= self.k
        last = np.r_[np.diff(self.query) != 0, True] if len(self.query) else np.zeros(0, bool)
        worst = np.full(len(self.ids), -np.inf)
        worst[self.query[last]] = self.score[last]
        self.cut = np.where(full, worst, self.cut)


def _pack(scale: int):
    """Quantised queries as blocks of one length, each at most BLOCK_BYTES."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for ids, vectors in matrices(part, scale):
                step = max(1, BLOCK_BYTES // (8 * max(1, vectors.shape[1])))
                for i in range(0, len(ids), step):
                    block = ids[i : i + step].astype("<i8"), vectors[i : i + step].astype("<f8")
                    yield pa.RecordBatch.from_pydict({"n": pa.array([len(block[0])], pa.int32()), "ids": pa.array([block[0].tobytes()], pa.binary()), "rows": pa.array([block[1].tobytes()], pa.binary())})

    return run


def blocks(queries: DataFrame, scale: int) -> Iterator[list[tuple[np.ndarray, np.ndarray]]]:
    """Groups of packed query blocks that come to BLOCK_BYTES at most; the driver holds one group at a time."""
    group: list[tuple[np.ndarray, np.ndarray]] = []
    held = 0
    for row in queries.mapInArrow(_pack(scale), "n int, ids binary, rows binary").toLocalIterator():
        block = np.frombuffer(row.ids, "<i8"), np.frombuffer(row.rows, "<f8").reshape(row.n, -1)
        if group and held + block[1].nbytes > BLOCK_BYTES:
            yield group
            group, held = [], 0
        group.append(block)
        held += block[1].nbytes
    if group:
        yield group


def _scan(shared, k: int, scale: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_length: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for ids, vectors in shared.value:
            by_length.setdefault(vectors.shape[1], []).append((ids, vectors))
        running = {n: Running(np.concatenate([b[0] for b in bs]), np.concatenate([b[1] for b in bs]), k) for n, bs in by_length.items()}
        for part in parts:
            for ids, vectors in matrices(part, scale):
                if vectors.shape[1] in running:
                    running[vectors.shape[1]].tile(ids, vectors)
        for r in running.values():
            yield pa.RecordBatch.from_pydict({"query_id": r.ids[r.query].astype(np.int64), "vec_id": r.found.astype(np.int64), "score": pa.array([min(max(int(s), LEAST), MOST) for s in r.score], pa.int64())})

    return run


def _merge(lists: DataFrame, k: int, *keys: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "vec_id")
    return lists.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(queries: DataFrame, vectors: DataFrame, k: int = 10, scale: int = 1024, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best of `vectors` for each row of `queries`, kept by a checkpoint."""
    spark = vectors.sparkSession
    batches(spark)
    asked = usable(queries, id_col, vec_col).groupBy("vec_id").agg(F.min("x").alias("x"))
    rows = usable(vectors, id_col, vec_col)
    found = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    with Scratch(spark, "topk") as scratch, batch_rows(spark, TILE_ROWS):
        for group in blocks(asked, scale):
            block = spark.sparkContext.broadcast(group)
            lists = rows.mapInArrow(_scan(block, k, scale), "query_id long, vec_id long, score long")
            lists = lists.withColumn("branch", F.spark_partition_id() % MERGE_FAN)
            merged = _merge(_merge(lists, k, "query_id", "branch").drop("rank"), k, "query_id")
            found = scratch.append(merged.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"), "found")
            block.destroy()
        return cut(found)


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return search(vectors.where(F.col("vec_id") % 100 == 0), vectors)


OP10_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(coalesce(list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.x) = len(q.x)
  WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM pairs
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""
