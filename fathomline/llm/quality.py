"""Quality by hierarchical empirical Bayes.

A document has evidence of its own: the log-odds of a logistic classifier over the shape of its text, learned from
labels and freed of the labels' base rate. Its site has a prior: hosts shrink toward the global rate, paths toward
their host. Both are Beta posteriors whose strength is estimated from how much sites differ (method of moments), over
grouped sums of all documents' classifier probabilities. A document's own share is taken out of the sums before they
judge it. Evidence and prior add up in log-odds.

A site text is split at its first slash into host and path; a path keeps its first segment. The classifier's sample is
bounded: SAMPLE labelled documents, chosen by a hash of the id; sums and scores cover all rows and whole texts.

Defined cases: null and empty texts have the shape of no text; a null site is the empty host; sites seen once get their
host's or the global rate; labels that are null teach nothing, and with one kind of label only the classifier is
neutral; a document with several labels has their mean, rounded up; repeated rows count and are scored each; an empty
table gives none; columns other than those named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomline.llm.common import batches, fold, join_groups, keep, table

#: Labelled documents that are learned from, steps and ridge of the regression, bins of each feature.
SAMPLE, STEPS, RIDGE, BINS = 12_000, 25, 1.0, 10
#: Sites that are broadcast at most, the largest; the others are joined by shuffling.
BROADCAST_SITES = 200_000
#: Bounds of a Beta prior's strength, in documents.
WEAKEST, STRONGEST = 2.0, 1000.0

_KIND = np.zeros(256, np.int64)  # other, lower, upper, digit, white space, sign, beyond ASCII
for _b in range(256):
    _c = chr(_b)
    _KIND[_b] = 6 if _b > 127 else 1 if _c.islower() else 2 if _c.isupper() else 3 if _c.isdigit() else 4 if _c.isspace() else 5 if _c.isprintable() else 0

FEATURES = 13


def shape(text: bytes | None) -> list[float]:
    """Numbers that describe a text's form."""
    raw = text or b""
    n = max(1, len(raw))
    kinds = np.bincount(_KIND[np.frombuffer(raw, np.uint8)], minlength=7) / n
    words, lines = raw.split(), raw.split(b"\n")
    w = max(1, len(words))
    different = len(set(words))
    signs = sum(raw.count(c) for c in (b"%", b"$", b"#", b"&", b"*", b"!", b"|", b"<", b"{"))
    return [
        np.log1p(len(raw)), *kinds[1:6], sum(map(len, words)) / w, different / w, np.log1p(w) - np.log1p(different),
        len({*lines}) / len(lines), n / len(lines) / 1000, signs / w, (raw.count(b".") + raw.count(b",")) / w,
    ]


@dataclass
class Classifier:
    """Weights of one-hot bins; edges are quantiles of the sample."""

    edges: list[np.ndarray]
    weights: np.ndarray
    bias: float

    def design(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros((len(x), len(self.edges) * BINS))
        for k, edge in enumerate(self.edges):
            out[np.arange(len(x)), k * BINS + np.searchsorted(edge, x[:, k], side="right")] = 1
        return out

    def evidence(self, x: np.ndarray) -> np.ndarray:
        """Log-odds without the base rate."""
        return self.design(x) @ self.weights + self.bias


def fit(x: np.ndarray, y: np.ndarray) -> Classifier:
    """Ridge logistic regression by Newton steps; x has FEATURES columns."""
    if not len(y) or y.all() or not y.any():
        return Classifier([np.zeros(BINS - 1)] * FEATURES, np.zeros(FEATURES * BINS), 0.0)
    edges = [np.quantile(x[:, k], np.arange(1, BINS) / BINS) for k in range(x.shape[1])]
    model = Classifier(edges, np.zeros(x.shape[1] * BINS), 0.0)
    d = np.c_[model.design(x), np.ones(len(x))]
    ridge = RIDGE * np.eye(d.shape[1])
    ridge[-1, -1] = 1e-6
    w = np.zeros(d.shape[1])
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(d @ w, -30, 30)))
        step = np.linalg.solve((d * (p * (1 - p))[:, None]).T @ d + ridge, d.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    rate = y.mean()
    return Classifier(edges, w[:-1], float(w[-1] - np.log(rate / (1 - rate))))


def _shapes(names: list[str]):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows = [[float(v) for v in shape(t)] for t in part.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), pa.array(rows, pa.list_(pa.float64()))], names=[*names, "x"])

    return run


def learn(docs: DataFrame, labels: DataFrame) -> tuple[Classifier, float]:
    """The classifier, and the labels' rate of good documents."""
    batches(docs.sparkSession)
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != 0))
    one = known.groupBy("doc_id").agg((F.avg(F.col("quality").cast("double")) >= 0.5).cast("int").alias("good"))
    size, good = one.agg(F.count("*"), F.coalesce(F.sum("good"), F.lit(0))).first()
    share = min(1.0, SAMPLE / max(1, size))
    chosen = one.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("good", "text")  # about SAMPLE rows
    got = rows.mapInArrow(_shapes(["good"]), "good int, x array<double>").collect()
    x = np.array([r["x"] for r in got]).reshape(len(got), FEATURES)
    return fit(x, np.array([r["good"] for r in got], float)), (good + 1) / (size + 2)


def evidence(docs: DataFrame, model: Classifier) -> DataFrame:
    """(doc_id, host, path, logit) of every row."""
    batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            x = np.array([shape(t) for t in part.column("text").cast(pa.binary()).to_pylist()]).reshape(part.num_rows, FEATURES)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("host"), part.column("path"), pa.array(shared.value.evidence(x), pa.float64())], names=["doc_id", "host", "path", "logit"])

    site = F.split(F.coalesce(F.col("site"), F.lit("")), "/", 3)
    rows = docs.select(F.col("doc_id").cast("long"), site[0].alias("host"), F.coalesce(F.get(site, F.lit(1)), F.lit("")).alias("path"), "text")
    return rows.mapInArrow(run, "doc_id long, host string, path string, logit double")


def log_odds(p: Column) -> Column:
    return F.log(p / (1 - p))


def strength(groups: DataFrame, mean: str) -> float:
    """Strength of the Beta prior from groups (n, s) around `mean`: how much rates differ beyond chance."""
    rate, n = F.col("s") / F.col("n"), F.col("n")
    m = F.col(mean)
    row = groups.agg(
        F.sum(n * (rate - m) * (rate - m)).alias("between"), F.sum(m * (1 - m)).alias("within"), F.sum(n).alias("n"), F.sum(n * m * (1 - m)).alias("whole"), F.count("*").alias("k")
    ).first()
    if not row["n"] or row["k"] < 2 or not row["whole"]:
        return STRONGEST
    spread = (row["between"] - row["within"]) / row["n"]
    return float(min(STRONGEST, max(WEAKEST, row["whole"] / row["n"] / max(spread, 1e-9) - 1)))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, evidence, prior, score, predicted. docs: doc_id, text, site; labels: doc_id, quality."""
    model, rate = learn(docs, labels)
    base = float(np.log(rate / (1 - rate)))
    rows = keep(evidence(docs, model).withColumn("p", 1 / (1 + F.exp(-(F.col("logit") + base)))))
    paths = keep(rows.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p").alias("s")))
    hosts = keep(paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s")))
    whole = hosts.agg(F.sum("n"), F.sum("s")).first()
    mean = (whole[1] or 0.0) / whole[0] if whole[0] else rate
    mean = min(max(mean, 1e-6), 1 - 1e-6)
    host_strength = strength(hosts.withColumn("m", F.lit(mean)), "m")
    by_host = hosts.select("host", F.col("n").alias("host_n"), F.col("s").alias("host_s"), ((F.col("s") + host_strength * mean) / (F.col("n") + host_strength)).alias("host_m"))
    nested = paths.join(by_host, "host")
    path_strength = strength(nested, "host_m")
    # The document's own share leaves the sums that judge it.
    host = (F.col("host_s") - F.col("p") + host_strength * mean) / (F.col("host_n") - 1 + host_strength)
    prior = (F.col("s") - F.col("p") + path_strength * host) / (F.col("n") - 1 + path_strength)
    joined = join_groups(rows, nested, ["host", "path"], "n", BROADCAST_SITES).select("doc_id", F.col("logit").alias("evidence"), F.least(F.greatest(prior, F.lit(1e-6)), F.lit(1 - 1e-6)).alias("prior"))
    made = joined.withColumn("score", 1 / (1 + F.exp(-(F.col("evidence") + log_odds(F.col("prior"))))))
    return made.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hosts are the documents' sources, paths their languages within them."""
    site = F.concat_ws("/", F.coalesce("source", F.lit("")), F.coalesce("lang", F.lit("")))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", site.alias("site"))
    got = score(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return got.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score", "predicted", "evidence", "prior")
