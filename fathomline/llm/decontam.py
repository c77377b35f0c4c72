"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingle containment.

Items and documents are sets of distinct shingles of WORDS words (letters and digits, lower case). A document is
contaminated by an item if it holds at least PERCENT hundredths of the item's shingles, however long it is.

Items are partitioned by size (powers of two). An item's MinHash sketch is its k smallest re-hashed shingles, where k
follows from the largest size of its partition so that fewer than k shingles may be missing: then no containment is
overlooked. A document is sketched for the partitions that it is large enough for: all its shingles whose re-hash does
not exceed the largest one in those partitions' sketches. It is a candidate for an item if the two sketches share as
many shingles as the threshold demands; the share of the item's sketch that is found estimates the containment.
Candidates are verified on the shingles' own words.

Everything is DataFrame functions. Sketches and candidates are broadcast behind a count, else joined by shuffling.

Defined cases: a text of fewer words than WORDS is one shingle of all its words; without words (null, empty) it matches
nothing; items that repeat are each reported; rows with one id give one row for each item, the one that holds most; a
null id is reported as null; empty tables give none; columns other than ids and texts are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomline.llm.common import keep, table

#: Words of a shingle, threshold in hundredths, rows that are broadcast at most.
WORDS, PERCENT, BROADCAST_ROWS = 5, 80, 1_000_000


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^\\p{L}\\p{N}]+", -1), lambda w: w != "")


def _shingles(text: Column, make_one, make_many, empty: str) -> Column:
    """Distinct shingles of a text. The words are bound by a lambda, so that the optimizer cannot copy their making into
    the function that runs for every shingle."""

    def of(w: Column) -> Column:
        n = F.size(w)
        many = F.when(n >= WORDS, F.transform(F.sequence(F.lit(0), n - WORDS), lambda i: make_many([F.get(w, i + k) for k in range(WORDS)])))
        one = F.when(n > 0, F.array(make_one(w)))
        return F.array_distinct(F.coalesce(many, one, F.array().cast(empty)))

    return F.get(F.transform(F.array(words(text)), of), F.lit(0))


def hashes(text: Column) -> Column:
    return _shingles(text, lambda w: F.xxhash64(F.lit(0), F.array_join(w, " ")), lambda five: F.xxhash64(*five), "array<long>")


def wordings(text: Column) -> Column:
    return _shingles(text, lambda w: F.array_join(w, " "), lambda five: F.concat_ws(" ", *five), "array<string>")


def least(size: Column) -> Column:
    """Shingles of an item of this size that a document must hold."""
    return F.floor((size * PERCENT + 99) / 100)


def bounded(df: DataFrame) -> DataFrame:
    """Broadcast if its counted rows are few."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def sketches(items: DataFrame) -> DataFrame:
    """(item_id, part, need, hits, k, order, h): the sketch's k shingles and re-hashes, the partition by size, the
    shingles that a document needs, and how many of the sketch must be among them."""
    sized = items.select("item_id", hashes(F.col("text")).alias("s")).withColumn("q", F.size("s")).where("q > 0")
    part = F.floor(F.log2(F.col("q"))).cast("int")
    largest = F.pow(F.lit(2), part + 1) - 1
    k = F.least(F.col("q"), (largest - least(largest) + 1).cast("int"))
    lowest = F.slice(F.array_sort(F.transform("s", lambda x: F.struct(rehash(x).alias("order"), x.alias("h")))), F.lit(1), k)
    need = least(F.col("q"))
    return sized.select("item_id", part.alias("part"), need.alias("need"), (k - (F.col("q") - need)).alias("hits"), k.alias("k"), F.inline(lowest))


def rehash(h: Column) -> Column:
    return F.xxhash64(h, F.lit(1))


def document_sketches(docs: DataFrame, sketched: DataFrame) -> DataFrame:
    """(doc_id, mark, d, h): the shingles of documents (doc_id, text) that any partition's sketches could hold."""
    # A row for each power of two: at most 31.
    parts = sketched.groupBy("part").agg(F.min("need").alias("need"), F.max("order").alias("top")).collect()
    none = F.lit(-(1 << 63))
    top = F.greatest(none, none, *(F.when(F.col("d") >= p["need"], F.lit(p["top"])).otherwise(none) for p in parts))
    rows = docs.select("doc_id", mark(F.col("text")).alias("mark"), hashes(F.col("text")).alias("s")).withColumn("d", F.size("s"))
    # An outer explode: for the inner one the optimizer would compute the shingles twice, to filter first.
    tokens = rows.select("doc_id", "mark", "d", top.alias("top"), F.explode_outer("s").alias("h"))
    return tokens.where(rehash(F.col("h")) <= F.col("top")).select("doc_id", "mark", "d", "h")


def mark(text: Column) -> Column:
    """Tells texts of one id apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def candidates(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, mark, item_id, estimate): pairs whose sketches share enough, with the estimated containment."""
    sketched = keep(sketches(items))
    found = document_sketches(docs, sketched).join(bounded(sketched.drop("part", "order")), "h").where(F.col("d") >= F.col("need"))
    counted = found.groupBy("doc_id", "mark", "item_id").agg(F.count("*").alias("held"), F.first("hits").alias("hits"), F.first("k").alias("k"))
    return counted.where(F.col("held") >= F.greatest(F.lit(1), "hits")).select("doc_id", "mark", "item_id", F.least(F.lit(1.0), F.col("held") / F.col("k")).alias("estimate"))


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, mark, item_id, item_shingles, shared_shingles of every text and item that reach the threshold."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.coalesce(F.col(item_text), F.lit("")).alias("text"))
    found = keep(candidates(docs, items)).select(F.col("doc_id").alias("c_id"), F.col("mark").alias("c_mark"), "item_id")
    texts = docs.withColumn("mark", mark(F.col("text"))).join(bounded(found), F.col("doc_id").eqNullSafe(F.col("c_id")) & (F.col("mark") == F.col("c_mark")))
    held = texts.select("doc_id", "mark", "item_id", wordings(F.col("text")).alias("d"))
    wanted = items.select(F.col("item_id").alias("i_id"), wordings(F.col("text")).alias("i")).where(F.size("i") > 0).groupBy("i_id").agg(F.collect_set("i").alias("is"))
    pairs = held.join(bounded(keep(wanted)), F.col("item_id").eqNullSafe(F.col("i_id"))).select("doc_id", "mark", "item_id", "d", F.explode("is").alias("i"))
    size, shared = F.size("i"), F.size(F.array_intersect("d", "i"))
    exact = pairs.select("doc_id", "mark", "item_id", size.cast("long").alias("item_shingles"), shared.cast("long").alias("shared_shingles"))
    return exact.where(F.col("shared_shingles") * 100 >= F.col("item_shingles") * PERCENT)


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, item_id, item_shingles, shared_shingles, containment of every pair that reaches the threshold."""
    exact = matches(docs, benchmark, id_col, text_col, item_col, item_text)
    best = exact.groupBy("doc_id", "item_id").agg(F.max(F.struct(F.col("shared_shingles") / F.col("item_shingles"), "shared_shingles", "item_shingles").alias("b")).alias("b"))
    return best.select("doc_id", "item_id", F.col("b.item_shingles"), F.col("b.shared_shingles"), (F.col("b.shared_shingles") / F.col("b.item_shingles")).alias("containment"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _sql_shingles(source: str, key: str) -> str:
    return f"""
  SELECT id, unnest(list_distinct(CASE WHEN len(w) >= {WORDS} THEN list_transform(range(1, len(w) - {WORDS} + 2), lambda i: array_to_string(w[i:i + {WORDS} - 1], ' '))
                                       WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS s
  FROM (SELECT {key} AS id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{N}}]+') AS w FROM {source})"""


OP5_SQL = f"""
WITH d AS ({_sql_shingles("documents", "doc_id")}
), i AS ({_sql_shingles("benchmark", "item_id")}
), sizes AS (SELECT id, count(*) AS n FROM i GROUP BY id
), shared AS (SELECT d.id AS doc_id, i.id AS item_id, count(*) AS n FROM d JOIN i ON d.s = i.s GROUP BY ALL
)
SELECT doc_id, item_id, CAST(sizes.n AS BIGINT) AS item_shingles, CAST(shared.n AS BIGINT) AS shared_shingles, shared.n / sizes.n AS containment
FROM shared JOIN sizes ON item_id = id WHERE shared.n * 100 >= sizes.n * {PERCENT}
"""
