"""Language identification with a string kernel.

Kernel: the blended-spectrum presence kernel, the number of n-grams of 1 to 3 letters (case-folded code points) that two
texts share, divided by the square roots of their own numbers. Nyström landmarks are texts of the training sample; the
one-versus-rest targets are fitted by kernel ridge regression in the landmarks' feature space. As the kernel is a
product of presence vectors, kernel times coefficients folds into one matrix (n-grams by languages), so that a batch
of texts is scored by one product of its presence matrix with that matrix.

Only n-grams that some landmark holds are features (all others add nothing to a kernel with a landmark), of all code
points that landmarks hold. Those of the ALPHABET most frequent code points are found in direct tables; the others, in
a sorted list of codes. The training sample reaches the driver as the texts' distinct n-grams, not as texts.

The training sample is bounded: about SAMPLE texts for each language, chosen by a hash of the id, and LANDMARKS landmarks
in all (4 for each language at least). Every language that a row is labelled with is learned. Everything else covers all rows
and whole texts.

Defined cases: text that is null or has no letter is `und` with score 0, as is every text if there is nothing to learn
from; rows with a null language teach nothing; repeated rows are predicted each; ties go to the language that sorts
first; an empty table gives none. `annotate` keeps all columns but those that it adds, which it replaces.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomline.llm.common import batches, fold, release, table

#: Training texts for each language, and landmarks in all.
SAMPLE, LANDMARKS = 240, 192
#: Parts into which a hash deals the ids when a language's share is taken.
PARTS = 1 << 20
#: Code points whose n-grams have direct tables, ALPHABET + 1 entries to the power of n. It bounds tables, not the features.
ALPHABET = 111
IDS = 1 + ALPHABET
#: Bits of a code point in an n-gram's code: three of them fit into 63.
BITS = 21
#: Ridge, relative to the number of texts; and the sharpness of the score.
RIDGE, SHARP = 1e-4, 4.0
#: Texts scored by one product, and code points of a text that are taken at once.
ROWS, STRETCH = 64, 1 << 18
UNKNOWN = "und"

_LETTER: np.ndarray | None = None


def letters() -> np.ndarray:
    """Whether a code point is a letter."""
    global _LETTER
    if _LETTER is None:
        _LETTER = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _LETTER


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def folded(c: int) -> int:
    low = chr(c).lower()
    return ord(low) if len(low) == 1 else c


_FOLDED: np.ndarray | None = None


def fold_points() -> np.ndarray:
    """Each code point, case-folded where that is one code point."""
    global _FOLDED
    if _FOLDED is None:
        _FOLDED = np.fromiter(map(folded, range(0x110000)), "<u4", 0x110000)
    return _FOLDED


def codes(cp: np.ndarray) -> list[np.ndarray]:
    """Codes of the 1-, 2- and 3-grams of code points; each is 1 more than its code point, so that lengths tell apart."""
    one = cp.astype(np.int64) + 1
    two = (one[:-1] << BITS) | one[1:]
    return [one, two, (two[:-1] << BITS) | one[2:]]


def stretches(cp: np.ndarray) -> Iterator[np.ndarray]:
    """A text in stretches of STRETCH code points that overlap by two, so that each n-gram stands in one."""
    for start in range(0, max(1, len(cp) - 2), STRETCH):
        yield cp[start : start + STRETCH + 2]


def spectrum(text: str | None) -> np.ndarray:
    """Distinct n-gram codes of a text, sorted."""
    found = [np.unique(np.concatenate(codes(fold_points()[cp]))) for cp in stretches(points(text or ""))]
    return np.unique(np.concatenate(found))


def split(code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of n-grams; -1 where a shorter one has none."""
    low = (1 << BITS) - 1
    return tuple(((code >> (BITS * k)) & low) - 1 for k in (2, 1, 0))


@dataclass
class Model:
    languages: list[str]
    ids: np.ndarray  # code point to place in the direct tables; 0 if it has none
    tables: tuple[np.ndarray, np.ndarray, np.ndarray]  # n-gram of ids to column, for 1, 2 and 3 code points; 0: none
    known: np.ndarray  # code points outside the tables that features hold
    sparse: tuple[np.ndarray, np.ndarray]  # sorted codes of the features outside the tables, and their columns
    weights: np.ndarray  # columns by languages

    def mark(self, row: np.ndarray, text: np.ndarray) -> None:
        """Set the columns of a text's n-grams in its row."""
        for cp in stretches(text):
            ids = self.ids[cp].astype(np.int32)
            two = ids[:-1] * IDS + ids[1:]
            for place, grams in zip(self.tables, (ids, two, two[:-1] * IDS + ids[2:]), strict=True):
                row[place[grams]] = 1
            if len(self.sparse[0]) and self.known[cp].any():
                wanted = np.unique(np.concatenate(codes(fold_points()[cp])))
                at = np.minimum(np.searchsorted(self.sparse[0], wanted), len(self.sparse[0]) - 1)
                row[self.sparse[1][at[self.sparse[0][at] == wanted]]] = 1
        row[0] = 0

    def presence(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Presence matrix (column 0 is unused and 0), and whether each text has a letter."""
        out, lettered = np.zeros((len(texts), self.weights.shape[0]), np.float32), np.zeros(len(texts), bool)
        for k, text in enumerate(texts):
            cp = points(text)
            lettered[k] = letters()[cp].any()
            self.mark(out[k], cp)
        return out, lettered

    def score(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        if not self.languages:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        x, lettered = self.presence([t or "" for t in texts])
        value = (x @ self.weights) / np.sqrt(np.maximum(1, x.sum(axis=1)))[:, None]
        p = np.exp(SHARP * (value - value.max(axis=1, keepdims=True)))
        p /= p.sum(axis=1, keepdims=True)
        top = value.argmax(axis=1)
        names = [self.languages[k] if ok else UNKNOWN for k, ok in zip(top, lettered, strict=True)]
        return names, [float(p[i, k]) if lettered[i] else 0.0 for i, k in enumerate(top)]


def _spectra(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        grams = pa.array([spectrum(t.as_py()).tobytes() for t in part.column("text")], pa.binary())
        yield pa.RecordBatch.from_arrays([part.column("lang"), part.column("doc_id"), grams], names=["lang", "doc_id", "grams"])
    release()


def sample(docs: DataFrame) -> list[tuple[np.ndarray, str]]:
    """About SAMPLE (spectrum, lang) for each language; held-out documents are left out.

    A language's share of its documents is taken by a hash of the id, so that no task ranks a language's documents.
    """
    batches(docs.sparkSession)
    known = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & (fold(F.col("doc_id")) != 0))
    counts = known.groupBy("lang").count().collect()
    if not counts:
        return []
    shares = [(r["lang"], max(1, round(PARTS * min(1.0, SAMPLE / r["count"])))) for r in counts]
    most = docs.sparkSession.createDataFrame(shares, "lang string, most long")  # a row for each language of the model
    chosen = known.join(F.broadcast(most), "lang").where(F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)) < F.col("most"))
    rows = chosen.select("lang", F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_spectra, "lang string, doc_id long, grams binary").collect()
    unique = {(r["lang"], r["doc_id"] is None, r["doc_id"] or 0, bytes(r["grams"])) for r in rows}
    return [(np.frombuffer(grams, np.int64), lang) for lang, _, _, grams in sorted(unique)]


def fit(texts: list[tuple[str, str]]) -> Model:
    return fit_spectra([(spectrum(t), lang) for t, lang in texts])


def fit_spectra(sample: list[tuple[np.ndarray, str]]) -> Model:
    """The model of (spectrum, language) pairs, in this order."""
    if not sample:
        return Model([], np.zeros(0x110000, np.uint8), (np.zeros(1, np.int32),) * 3, np.zeros(0x110000, bool), (np.zeros(0, np.int64),) * 2, np.zeros((1, 0), np.float32))
    languages = sorted({lang for _, lang in sample})
    each = max(4, LANDMARKS // len(languages))
    chosen = [s for lang in languages for s in [s for s, x in sample if x == lang][:each]]
    features, held = np.unique(np.concatenate(chosen), return_counts=True)  # column k + 1 is features[k]
    columns = np.arange(1, len(features) + 1, dtype=np.int32)

    # The code points with direct tables: those that most landmarks hold.
    single = features < 1 << BITS
    frequent = features[single][np.lexsort((features[single], -held[single]))][:ALPHABET] - 1
    ids = np.zeros(0x110000, np.uint8)
    ids[frequent] = np.arange(1, len(frequent) + 1)
    ids = ids[fold_points()]
    parts = split(features)
    place = [np.where(p >= 0, ids[np.maximum(p, 0)], 0).astype(np.int64) for p in parts]
    size = (parts[0] >= 0).astype(int) + (parts[1] >= 0) + 1
    direct = np.logical_and.reduce([(p < 0) | (i > 0) for p, i in zip(parts, place, strict=True)])
    tables = []
    for n in (1, 2, 3):
        table = np.zeros(IDS**n, np.int32)
        here = direct & (size == n)
        at = reduce(lambda whole, k: whole * IDS + place[k][here], range(3 - n, 3), np.zeros(here.sum(), np.int64))  # noqa: B023
        table[at] = columns[here]
        tables.append(table)
    rare = np.zeros(0x110000, bool)
    rare[features[single] - 1] = True
    known = (rare & (ids == 0))[fold_points()]
    model = Model(languages, ids, tuple(tables), known, (features[~direct], columns[~direct]), np.zeros((len(features) + 1, len(languages)), np.float32))

    def unit(spectra: list[np.ndarray]) -> np.ndarray:
        """Rows of presence, divided by the square roots of their numbers of features."""
        out = np.zeros((len(spectra), len(features) + 1), np.float32)
        for row, s in zip(out, spectra, strict=True):
            row[1 + np.flatnonzero(np.isin(features, s, assume_unique=True))] = 1
        return out / np.sqrt(np.maximum(1, out.sum(axis=1)))[:, None]

    landmarks = unit(chosen)
    inner = (landmarks @ landmarks.T).astype(np.float64)
    values, vectors = np.linalg.eigh(inner)
    good = values > 1e-6 * values[-1]
    root = vectors[:, good] / np.sqrt(values[good])  # K(x, landmarks) @ root: Nyström features
    z = np.concatenate([unit([s for s, _ in sample[i : i + ROWS]]) @ landmarks.T for i in range(0, len(sample), ROWS)]) @ root
    target = np.array([[1.0 if lang == x else -1.0 for x in languages] for _, lang in sample])
    numbers = Counter(lang for _, lang in sample)
    weight = np.array([1.0 / numbers[lang] for _, lang in sample])[:, None] * len(sample) / len(languages)
    solved = np.linalg.solve(z.T @ (z * weight) + RIDGE * len(sample) * np.eye(z.shape[1]), z.T @ (target * weight))
    model.weights = (landmarks.T @ (root @ solved)).astype(np.float32)
    return model


def lettered(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Rows whose text has a letter."""
    batches(docs.sparkSession)
    at = docs.columns.index(text_col)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            yield part.filter(pa.array([bool(letters()[points(t.as_py() or "")].any()) for t in part.column(at)], pa.bool_()))
        release()

    return docs.mapInArrow(run, docs.schema)


def annotate(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """All columns of docs, with lang_pred and score."""
    spark = docs.sparkSession
    batches(spark)
    shared = spark.sparkContext.broadcast(model)  # bounded by the tables and the landmarks' n-grams
    kept = docs.drop("lang_pred", "score")
    names = kept.columns

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for part in parts:
            texts = part.column(names.index(text_col))
            found = [m.score(texts.slice(i, ROWS).to_pylist()) for i in range(0, len(texts), ROWS)]
            lang, score = pa.array([x for f in found for x in f[0]], pa.string()), pa.array([x for f in found for x in f[1]], pa.float64())
            yield pa.RecordBatch.from_arrays([*part.columns, lang, score], names=[*names, "lang_pred", "score"])
        release()

    schema = kept.withColumns({"lang_pred": F.lit("").cast("string"), "score": F.lit(0.0)}).schema
    return kept.mapInArrow(run, schema)


def learn(docs: DataFrame) -> Model:
    model = fit_spectra(sample(docs))
    release()
    return model


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = annotate(docs.select("doc_id", "text"), learn(docs))
    return out.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "lang_pred", "score")
