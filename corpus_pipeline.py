"""A corpus pipeline: language ID, line dedup, near-duplicate removal, decontamination, tokens.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. Stages 1 to 4 return the columns of
documents; the last returns each document's token count and digests. Defined cases: rows that repeat an id are one
document: their lines count once, one row of them survives the near-duplicate stage (the first by its columns, in the
order of documents); rows with a null id are documents that the near-duplicate stage keeps, as nothing else tells them
apart, while line dedup and decontamination judge them by their texts; empty tables stay empty; further columns go.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomline.llm import bpe, decontam, langid, linededup, ngramjoin
from fathomline.llm.common import Scratch, cut, keep

#: Near duplicates: words of a shingle, and the threshold in hundredths (op6_ngram_join has its own).
NEAR_WORDS, NEAR_PERCENT = 5, 80
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language go: null texts and texts without a letter, also with nothing to learn from."""
    docs = docs.select(*COLUMNS)
    model = langid.learn(docs)
    if not model.languages:
        return langid.lettered(docs)
    found = langid.annotate(docs, model)
    return found.where(F.col("lang_pred") != langid.UNKNOWN).select(*COLUMNS)


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten documents or more share go; texts and their lengths change."""
    kept = linededup.dedupe(docs.select(*COLUMNS))
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component the document with the smallest id stays."""
    docs = docs.select(*COLUMNS)
    found = ngramjoin.join(docs, words=NEAR_WORDS, percent=NEAR_PERCENT)
    gone = _bounded(found.where(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct())
    kept = docs.join(gone, "doc_id", "left_anti")
    twice = keep(found.where(F.col("doc_id").isNotNull()).groupBy("doc_id").count().where("count > 1").select("doc_id"))
    if twice.isEmpty():
        return kept.select(*COLUMNS)
    twice = _bounded(twice)
    first = kept.join(twice, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct(*COLUMNS[1:])).alias("row"))
    return kept.join(twice, "doc_id", "left_anti").select(*COLUMNS).unionByName(first.select("doc_id", "row.*"))


def _bounded(ids: DataFrame) -> DataFrame:
    """Broadcast if the counted ids are few."""
    ids = keep(ids)
    return F.broadcast(ids) if ids.count() <= ngramjoin.BROADCAST_PAIRS else ids


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go, told apart by id and text."""
    docs = docs.select(*COLUMNS)
    found = decontam.matches(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    gone = _bounded(found.select(F.col("doc_id").cast("long").alias("gone"), F.col("mark").alias("gone_mark")).distinct())
    same = F.col("doc_id").eqNullSafe(F.col("gone")) & (decontam.mark(F.col("text")) == F.col("gone_mark"))
    return docs.join(gone, same, "left_anti").select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded bytes."""
    import public_tokenizers

    return bpe.digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_common_lines),
    ("ngram_join", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("byte_bpe", encode),
]

# The learned first stage has no SQL; tests hold the rest against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with Scratch(spark, "pipeline") as scratch:
        for _, stage in STAGES[:-1]:
            docs = scratch.store(stage(spark, docs, sf_dir))
        return cut(STAGES[-1][1](spark, docs, sf_dir))
