"""Toxicity by noisy-channel deobfuscation.

The clean text is taken to have passed a channel that swaps letters for look-alikes, puts separators between letters and
repeats letters. Every span of a text that may show this is a character lattice; Viterbi decoding under a character
trigram model picks the likeliest clean span. The model is counted over all documents given. The restored words (and
the words as they stand) are then scored.

The score: a list of features (words, and word beginnings of PREFIXES letters), chosen greedily by the likelihood ratio
among labelled documents that no earlier feature covers, so that words that merely travel with copies of a toxic
document are not taken up. Each feature has the smoothed share of toxic documents among those that hold it, weighted
to the labels' real proportions; a document's features combine as a noisy or, over the rate of documents without any.

The labelled sample is bounded: about SAMPLE documents of either label, chosen by a hash of the id; all else covers all rows
and whole texts. Defined cases: null and empty texts have no features and get the base rate; repeated rows are scored
each; a document with several labels counts as toxic if one says so; null labels teach nothing, and with no labels all
scores are 0; an empty table gives none; the result has the id and the columns listed, whatever else the input has.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomline.llm.common import batches, fold, keep, table

#: Labelled documents of either label that are learned from; features that are weighed in the driver at once.
SAMPLE, CANDIDATES = 5000, 1500
#: Parts into which a hash deals the ids when a label's share is taken.
PARTS = 1 << 20
#: Lengths of word beginnings; least likelihood ratio (G squared) and toxic documents of a feature among those that none
#: covers yet; its least share of toxic documents in the whole sample.
PREFIXES, LEAST_RATIO, LEAST_HELD, LEAST_SHARE = (4, 5, 6), 13.0, 3, 0.8
#: The same for features that are taken though others cover their documents.
STRONG_RATIO, STRONG_SHARE = 20.0, 0.97
#: Remembered tokens of a worker.
MEMORY = 400_000

# The look-alikes of the channel.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "*": "aeiou", "#": "h",
}
SEPARATORS = frozenset(" .-_*~'\"/\\,")
#: Costs in nats: a look-alike, keeping a sign as a break, dropping a separator, collapsing or keeping a repetition.
SWAP, KEEP, JOIN, COLLAPSE, REPEAT = 1.0, 6.0, 0.4, 0.7, 2.0

# The alphabet of the character model: 0 is a break, then a-z, then U+00E0 to U+00FF, then one id for all other letters.
LETTERS = 26 + 32 + 2

_WORD = re.compile(r"[^\W\d_]+")
_SPACED = re.compile(r"(?<!\S)\S(?:[ .\-_*]{1,3}\S){2,}(?!\S)")
_REPEAT = re.compile(r"([^\W\d_])\1")
_THRICE = re.compile(r"([^\W\d_])\1\1")
_PLAIN_START = re.compile(r"(?:([^\W\d_])(?!\1\1))*")
_SIGN = re.compile("[" + re.escape("".join(LOOKALIKES)) + "]")
#: What may stand around a word: signs that are no look-alikes, and those that are.
PLAIN, ALIKE = ".,;:?\"')[]{}<>%&", "!(|*#$"


def letter_id(c: str) -> int:
    if "a" <= c <= "z":
        return ord(c) - 96
    if "\xe0" <= c <= "\xff" and c != "\xf7":
        return ord(c) - 0xE0 + 27
    return LETTERS - 1 if c.isalpha() else 0


_IDS: np.ndarray | None = None


def code_points() -> np.ndarray:
    """From a code point to the id of its lower case."""
    global _IDS
    if _IDS is None:
        _IDS = np.fromiter((letter_id(chr(c).lower()[0]) for c in range(0x110000)), np.uint8, 0x110000)
    return _IDS


def _count_trigrams(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(LETTERS**3, np.int64)
    for part in parts:
        # Texts one behind the other, two breaks before each and one at the end.
        raw = np.frombuffer("\0\0".join(["", *(t or "" for t in part.column(0).to_pylist()), ""]).encode("utf-32-le", "surrogatepass"), "<u4")
        ids = code_points()[raw].astype(np.int32)
        codes = (ids[:-2] * LETTERS + ids[1:-1]) * LETTERS + ids[2:]
        # A text ends with one break: the windows at the end of one that hold two are no trigrams of it.
        sizes = np.fromiter((len(t or "") for t in part.column(0).to_pylist()), np.int64, part.num_rows)
        ends = np.cumsum(sizes + 2) - 1  # the last letter of each text, or the break before an empty one
        inside = np.ones(len(codes), bool)
        inside[ends[ends < len(codes)]] = False
        total += np.bincount(codes[inside], minlength=LETTERS**3)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_pydict({"code": pa.array(at, pa.int64()), "n": pa.array(total[at], pa.int64())})


@dataclass
class CharModel:
    """log P(c | a, b), interpolated from trigrams, bigrams and single letters."""

    log_p: np.ndarray

    @cached_property
    def costs(self) -> list[float]:
        """-log P of c after a and b at place (a * LETTERS + b) * LETTERS + c: a list is read faster, one by one."""
        return (-self.log_p.astype(float)).ravel().tolist()

    @staticmethod
    def of(docs: DataFrame, text_col: str = "text") -> CharModel:
        """Counted over all rows; what comes back is bounded by the alphabet."""
        batches(docs.sparkSession)
        found = docs.select(text_col).mapInArrow(_count_trigrams, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).toPandas()
        count = np.zeros(LETTERS**3)
        count[found["code"].to_numpy(dtype=np.int64)] = found["n"].to_numpy(dtype=float)
        return CharModel.from_counts(count.reshape((LETTERS,) * 3))

    @staticmethod
    def from_counts(three: np.ndarray) -> CharModel:
        two, one = three.sum(axis=0), three.sum(axis=(0, 1))
        p1 = (one + 1) / (one.sum() + LETTERS)
        p2 = (two + 5 * p1) / (two.sum(axis=1, keepdims=True) + 5)
        p3 = (three + 5 * p2) / (three.sum(axis=2, keepdims=True) + 5)
        return CharModel(np.log(p3).astype(np.float32))


def arcs(span: str, i: int, doubled: bool = False) -> list[tuple[str, int, float]]:
    """(letters written, next position, cost) of the lattice at position i; a blank is a break between words.

    With `doubled`, a letter that stands twice may be one.
    """
    c = span[i]
    if c.isalpha():
        run = i + 1
        while run < len(span) and span[run] == c:
            run += 1
        if run - i < 3:
            return [(c, i + 1, 0.0), *([(c, run, COLLAPSE)] if doubled and run - i == 2 else ())]
        return [(c, run, COLLAPSE), (c * 2, run, COLLAPSE), (c * (run - i), run, REPEAT * (run - i - 2))]
    return [(written, i + 1, cost) for written, cost in sign_arcs(c)]


@lru_cache(maxsize=1 << 12)
def sign_arcs(c: str) -> list[tuple[str, float]]:
    """What a sign that is no letter may stand for: a break, a letter, or nothing."""
    out = [(" ", KEEP if c in LOOKALIKES else 2.0 if c.isspace() else 1.0)]
    out += [(x, SWAP) for x in LOOKALIKES.get(c, "")]
    if c in SEPARATORS:
        out.append(("", JOIN))
    return out


def written_by(path: list | None) -> str:
    out = []
    while path is not None:
        out.append(path[1])
        path = path[0]
    return "".join(reversed(out))


def settle(paths: list[list | None]) -> str:
    """What all paths have written in common; it is taken off them."""
    chain, place, path = [], {}, paths[0]
    while path is not None:
        place[id(path)] = len(chain)
        chain.append(path)
        path = path[0]
    oldest = 0
    for path in paths:
        while path is not None and id(path) not in place:
            path = path[0]
        if path is None:
            return ""
        oldest = max(oldest, place[id(path)])
    text = written_by(chain[oldest])
    chain[oldest][:] = None, ""
    return text


@lru_cache(maxsize=1 << 14)
def ids_of(written: str) -> tuple[int, ...]:
    return tuple(map(letter_id, written))


def decode(span: str, model: CharModel, doubled: bool = False) -> str:
    """The likeliest clean form of a span (lower case)."""
    # The state is what was written last (two ids, as one number); each keeps its best cost and its path, back to what is settled.
    # Plain letters at the start can only be written as they are.
    costs, settled, state, before = model.costs, [], 0, 0.0
    start = 0 if doubled else _PLAIN_START.match(span).end()
    for c in ids_of(span[:start]):
        before += costs[state * LETTERS + c]
        state = state % LETTERS * LETTERS + c
    layers: dict[int, dict[int, tuple[float, list | None]]] = {start: {state: (before, [None, span[:start]])}}
    for i in range(start, len(span)):
        here = layers.pop(i, None)
        if here is None:
            continue
        for written, stop, cost in arcs(span, i, doubled):
            ids = ids_of(written)
            there = layers.setdefault(stop, {})
            for state, (before, path) in here.items():
                total = before + cost
                for c in ids:
                    last = state % LETTERS
                    if c or last:  # a break after a break is free
                        total += costs[state * LETTERS + c]
                        state = last * LETTERS + c
                known = there.get(state)
                if known is None or total < known[0]:
                    there[state] = (total, [path, written])
        if i % LONGEST == LONGEST - 1:
            settled.append(settle([path for layer in layers.values() for _, path in layer.values()]))
    ends = [(cost + (costs[state * LETTERS] if state % LETTERS else 0.0), path) for state, (cost, path) in layers[len(span)].items()]
    least = min(cost for cost, _ in ends)
    return "".join(settled) + min(written_by(path) for cost, path in ends if cost == least)


def undouble(word: str, places: list[int], model: CharModel) -> str:
    """The same for a word of letters with some doubled ones (at `places`): each of them read once or twice.

    Reading a letter once changes the cost of itself and of the next letter only, so doubles with a letter in between
    are settled one by one, runs of neighbouring doubles together.
    """
    costs, ids = model.costs, (0, *ids_of(word), 0)  # ids[p + 1] is the letter at p
    dropped: set[int] = set()
    for group in neighbours(places):
        before, after = ids[group[0]], ids[group[-1] + 3]
        best = None
        for way in range(1 << len(group)):
            total, a, b = 0.0, before, ids[group[0] + 1]
            for k, p in enumerate(group):
                c = ids[p + 1]
                if k:
                    total += costs[(a * LETTERS + b) * LETTERS + c]
                    a, b = b, c
                if way >> k & 1:
                    total += COLLAPSE
                else:
                    total += costs[(a * LETTERS + b) * LETTERS + c]
                    a, b = b, c
            total += costs[(a * LETTERS + b) * LETTERS + after]
            if best is None or total < best[0]:
                best = total, way
        dropped.update(p for k, p in enumerate(group) if best[1] >> k & 1)
    return "".join(c for i, c in enumerate(word) if i not in dropped) if dropped else word


def neighbours(places: list[int]) -> list[list[int]]:
    """Places of doubles, those that follow each other without a letter in between together."""
    out = [places[:1]]
    for p in places[1:]:
        if p == out[-1][-1] + 2:
            out[-1].append(p)
        else:
            out.append([p])
    return out


#: After so many signs of a span, what all paths have in common is settled; paths stay short.
LONGEST = 200


class Restorer:
    """Words of texts, as they stand and restored, with a bounded memory of tokens."""

    def __init__(self, model: CharModel) -> None:
        self.model, self.memory = model, {}

    def restored(self, span: str) -> list[str]:
        if span.isalpha() and not _THRICE.search(span):
            # Nothing but letters, at most doubled: the span itself, and it without some of the doubles.
            places = [m.start() for m in _REPEAT.finditer(span)]
            if all(len(group) <= 3 for group in neighbours(places)):
                return [span, undouble(span, places, self.model)] if places else [span]
        words = _WORD.findall(decode(span, self.model))
        # Doubled letters are mostly a word's own, so they are also read as single ones, not instead.
        return words + (_WORD.findall(decode(span, self.model, True)) if _REPEAT.search(span) else [])

    def of_token(self, token: str) -> tuple[str, ...]:
        if token.isalpha() and not _REPEAT.search(token):
            return (token,)
        words = _WORD.findall(token)
        if not words:
            return ()
        # Look-alikes at either end may stand for letters or decorate the word.
        whole, inner = token.strip(PLAIN), token.strip(PLAIN + ALIKE)
        apart = len(words) > 2 and len(words) * 2 >= len(inner.strip("-._"))
        spans = [s for s in {whole, whole.lstrip(ALIKE), whole.rstrip(ALIKE), inner} if apart or _REPEAT.search(s) or _SIGN.search(s)]
        return tuple({*words, *(w for s in spans for w in self.restored(s))})

    def words(self, text: str | None) -> set[str]:
        low = (text or "").lower()
        out: set[str] = set()
        if len(self.memory) > MEMORY:
            self.memory.clear()
        for token in set(low.split()):
            words = self.memory.get(token)
            if words is None:
                words = self.memory[token] = self.of_token(token)
            out.update(words)
        for span in _SPACED.finditer(low):
            out.update(self.restored(span.group()))
        return out


def features(word: str) -> list[str]:
    return [f"={word}", *(f"^{word[:n]}" for n in PREFIXES if len(word) >= n)]


@dataclass
class Toxic:
    """The learned scorer: shares of toxic documents by feature, and the rate of documents without any feature."""

    model: CharModel
    share: dict[str, float]
    base: float

    @cached_property
    def by_length(self) -> tuple[dict[str, float], list[tuple[int, dict[str, float]]]]:
        """Shares of words, and of beginnings by their length."""
        begins = [(n, {f[1:]: x for f, x in self.share.items() if f[0] == "^" and len(f) == n + 1}) for n in PREFIXES]
        return {f[1:]: x for f, x in self.share.items() if f[0] == "="}, [b for b in begins if b[1]]

    def evidence(self, word: str) -> float:
        words, begins = self.by_length
        most = words.get(word, 0.0)
        for n, held in begins:
            if len(word) >= n:
                most = max(most, held.get(word[:n], 0.0))
        return most


class Scorer:
    """`known` tokens have been looked at; those with evidence are in `hits` with their words."""

    def __init__(self, toxic: Toxic) -> None:
        self.toxic, self.restorer = toxic, Restorer(toxic.model)
        self.known: set[str] = set()
        self.hits: dict[str, tuple[str, ...]] = {}

    def of_token(self, token: str) -> tuple[str, ...]:
        """Words with evidence among a token's words."""
        return tuple(w for w in self.restorer.of_token(token) if self.toxic.evidence(w))

    def score(self, text: str | None) -> float:
        if len(self.known) > MEMORY:
            self.known.clear()
            self.hits.clear()
        low, found = (text or "").lower(), set()
        tokens = set(low.split())
        new = tokens - self.known
        for token in new:
            if words := self.of_token(token):
                self.hits[token] = words
        self.known |= new
        for token in tokens & self.hits.keys():
            found.update(self.hits[token])
        for span in _SPACED.finditer(low):
            found.update(w for w in self.restorer.restored(span.group()) if self.toxic.evidence(w))
        clean = 1.0 - self.toxic.base
        for word in sorted(found):
            clean *= 1.0 - self.toxic.evidence(word)
        return 1.0 - clean


def labelled(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, dict[int, float]]:
    """About SAMPLE training documents of either label (doc_id, text, toxic), and what each stands for."""
    one = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != 0)).groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    sizes = {r["toxic"]: r["count"] for r in one.groupBy("toxic").count().collect()}
    # A share of either label by a hash of the id, so that no task ranks a label's documents.
    most = F.when(F.col("toxic") == 1, F.lit(round(PARTS * min(1.0, SAMPLE / max(1, sizes.get(1, 0)))))).otherwise(F.lit(round(PARTS * min(1.0, SAMPLE / max(1, sizes.get(0, 0))))))
    chosen = one.where(F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)) < most)
    texts = docs.select(F.col("doc_id"), F.col("text")).where(F.col("text").isNotNull())
    weight = {k: max(1.0, n / SAMPLE) for k, n in sizes.items()}
    return texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic"), weight  # about 2 * SAMPLE rows


def _features(shared):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(shared.value)
        for part in parts:
            held = [sorted({f for w in restorer.words(t.as_py()) for f in features(w)}) for t in part.column("text")]
            yield pa.RecordBatch.from_pydict({"toxic": part.column("toxic").cast(pa.int64()), "held": pa.array(held, pa.list_(pa.string()))})

    return run


def _count_features(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of either label that hold a feature."""
    for part in parts:
        clean, toxic = Counter(), Counter()
        for held, label in zip(part.column("held"), part.column("toxic").to_pylist(), strict=True):
            (toxic if label else clean).update(held.as_py())
        names = sorted({*clean, *toxic})
        yield pa.RecordBatch.from_pydict({"feature": pa.array(names, pa.string()), "clean": pa.array([clean[n] for n in names], pa.int64()), "toxic": pa.array([toxic[n] for n in names], pa.int64())})


def _only(shared, chosen: set[str] = frozenset()):
    """Documents that hold none of the chosen features, with those of their features that are shared."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        for part in parts:
            labels, found = [], []
            for held, label in zip(part.column("held"), part.column("toxic").to_pylist(), strict=True):
                names = held.as_py()
                if chosen.isdisjoint(names):
                    labels.append(label)
                    found.append([n for n in names if n in wanted])
            yield pa.RecordBatch.from_pydict({"toxic": pa.array(labels, pa.int64()), "held": pa.array(found, pa.list_(pa.string()))})

    return run


def _hold_features(names: list[str], chosen: set[str]):
    """Which of the names each document holds (bits), of documents that hold none of the chosen features."""
    at = {n: i for i, n in enumerate(names)}

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            labels, bits = [], []
            for held, toxic in zip(part.column("held"), part.column("toxic").to_pylist(), strict=True):
                found = held.as_py()
                if chosen.isdisjoint(found):
                    row = np.zeros(len(names), bool)
                    row[[at[f] for f in found if f in at]] = True
                    labels.append(toxic)
                    bits.append(np.packbits(row).tobytes())
            yield pa.RecordBatch.from_pydict({"toxic": pa.array(labels, pa.int64()), "bits": pa.array(bits, pa.binary())})

    return run


def hold(kept: DataFrame, names: list[str], chosen: set[str]) -> tuple[np.ndarray, np.ndarray]:
    """Documents (rows) by names, and whether each is toxic."""
    rows = kept.mapInArrow(_hold_features(names, chosen), "toxic long, bits binary").collect()
    bits = np.frombuffer(b"".join(r["bits"] for r in rows), np.uint8).reshape(len(rows), -1)
    return np.unpackbits(bits, axis=1, count=len(names)).astype(bool), np.array([r["toxic"] == 1 for r in rows], bool)


def ratio(a, b, toxic: float, clean: float):
    """G squared of a feature held by a toxic and b clean documents, 0 where it speaks for clean ones."""
    a, b = np.asarray(a, float), np.asarray(b, float)
    total = toxic + clean
    term = lambda x, e: np.where(x > 0, x * np.log(np.maximum(x, 1e-9) / np.maximum(e, 1e-9)), 0.0)
    g = 2 * (term(a, (a + b) * toxic / total) + term(b, (a + b) * clean / total) + term(toxic - a, (total - a - b) * toxic / total) + term(clean - b, (total - a - b) * clean / total))
    return np.where(a * clean > b * toxic, g, 0.0)


def ratio_of(a: Column, b: Column, toxic: int, clean: int) -> Column:
    """The same on columns."""
    total = float(toxic + clean)
    term = lambda x, e: F.when(x > 0, x * F.log(x / e)).otherwise(0.0)
    part = lambda x, y, n: (x + y) * F.lit(n / total)
    c, d = F.lit(toxic) - a, F.lit(clean) - b
    g = term(a, part(a, b, toxic)) + term(b, part(a, b, clean)) + term(c, part(c, d, toxic)) + term(d, part(c, d, clean))
    return F.when(a * clean > b * toxic, 2 * g).otherwise(0.0)


def alone(kept: DataFrame, lean: list[str], strong: list[str]) -> list[str]:
    """Strong features of the whole sample whose documents have little else in common with features that lean.

    Words that travel with copies of one document share their documents with many others; a toxic word does not. The
    driver holds two pages of features at once; those that are out meet no further page.
    """
    own = kept.where("toxic = 1")
    out: list[str] = []
    for i in range(0, len(strong), CANDIDATES):
        page = strong[i : i + CANDIDATES]
        stems: dict[str, set[str]] = {n: set() for n in page}
        for other in [page, *(lean[j : j + CANDIDATES] for j in range(0, len(lean), CANDIDATES))]:
            page = [n for n in page if len(stems[n] - {n[1:5]}) <= 1]
            if not page:
                break
            held, _ = hold(own, page + other, set())
            x, y = held[:, : len(page)].astype(np.float32), held[:, len(page) :].astype(np.float32)
            both = x.T @ y
            alike = both > 0.5 * (x.sum(axis=0)[:, None] + y.sum(axis=0)[None, :] - both)
            for n, row in zip(page, alike, strict=True):
                stems[n].update(other[j][1:5] for j in np.flatnonzero(row))
        out += [n for n in page if len(stems[n] - {n[1:5]}) <= 1]
    return out


def choose(names: list[str], held: np.ndarray, toxic: np.ndarray) -> list[str]:
    """Greedy choice of features among documents (rows of `held`) that none covers yet."""
    chosen: list[str] = []
    open_ = np.ones(len(toxic), bool)
    while toxic[open_].any():
        a, b = held[open_ & toxic].sum(axis=0), held[open_ & ~toxic].sum(axis=0)
        g = ratio(a, b, (open_ & toxic).sum(), (open_ & ~toxic).sum())
        g[a < LEAST_HELD] = 0.0
        # Among equals the shorter: a beginning that stands for many words.
        k = min(range(len(names)), key=lambda i: (-g[i], len(names[i]), names[i]))
        if g[k] < LEAST_RATIO:
            break
        chosen.append(names[k])
        open_ &= ~held[:, k]
    return chosen


def learn(docs: DataFrame, labels: DataFrame) -> Toxic:
    spark = docs.sparkSession
    batches(spark)
    model = CharModel.of(docs)
    sample, weight = labelled(docs, labels)
    if not weight.get(1) or not weight.get(0):
        return Toxic(model, {}, 0.0)
    shared = spark.sparkContext.broadcast(model)  # LETTERS ** 3 numbers
    held, counts = "toxic long, held array<string>", "feature string, clean long, toxic long"
    every = keep(sample.select("text", "toxic").mapInArrow(_features(shared), held))
    sizes = {r["toxic"]: r["count"] for r in every.groupBy("toxic").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    summed = lambda df: df.mapInArrow(_count_features, counts).groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    bad, good = F.col("toxic") * weight[1], F.col("clean") * weight[0]
    counted = summed(every).where(F.col("toxic") >= LEAST_HELD).withColumn("whole", (bad + 0.1) / (bad + good + 0.3))
    leaning = (F.col("toxic") * max(clean, 1) > 2 * F.col("clean") * max(toxic, 1)).alias("lean")
    able = (F.col("whole") >= LEAST_SHARE).alias("able")
    rows = counted.select("feature", "toxic", "whole", leaning, able, ratio_of(F.col("toxic"), F.col("clean"), toxic, clean).alias("g")).where("lean OR able").collect() if toxic else []
    # From here on only features matter that may be chosen or that the strong ones are compared with.
    wanted = spark.sparkContext.broadcast({r["feature"] for r in rows})
    kept = keep(every.mapInArrow(_only(wanted), held))
    whole = {r["feature"]: r["whole"] for r in rows if r["able"]}
    choosable = spark.sparkContext.broadcast(set(whole))
    share: dict[str, float] = {}
    left, others = toxic, clean
    # Features are counted anew among the documents that are still open, until none of them passes.
    while left:
        open_ = summed(kept.mapInArrow(_only(choosable, set(share)), held)).where(F.col("toxic") >= LEAST_HELD)
        open_ = open_.withColumn("g", ratio_of(F.col("toxic"), F.col("clean"), left, others)).where(F.col("g") >= LEAST_RATIO)
        names = [r["feature"] for r in open_.orderBy(F.desc("g"), F.length("feature"), "feature").limit(CANDIDATES).collect()]
        chosen = choose(names, *hold(kept, names, set(share))) if names else []
        if not chosen:
            break
        share |= {n: whole[n] for n in chosen}
        sizes = {r["toxic"]: r["count"] for r in kept.mapInArrow(_only(choosable, set(share)), held).groupBy("toxic").count().collect()}
        left, others = sizes.get(1, 0), sizes.get(0, 0)
    lean = sorted((r for r in rows if r["lean"]), key=lambda r: (-r["toxic"], r["feature"]))
    strong = {r["feature"]: r["whole"] for r in lean if r["g"] >= STRONG_RATIO and r["whole"] >= STRONG_SHARE}
    for n in alone(kept, [r["feature"] for r in lean], list(strong)):
        share.setdefault(n, strong[n])
    for df in (kept, every):
        df.unpersist()
    rest = left * weight[1]
    return Toxic(model, share, (rest + 0.1) / (rest + others * weight[0] + 10.0))


def score(docs: DataFrame, toxic: Toxic, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score and predicted of every row."""
    batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(toxic)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for part in parts:
            got = [scorer.score(t.as_py()) for t in part.column("text")]
            yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "score": pa.array(got, pa.float64()), "predicted": pa.array([int(s >= 0.5) for s in got], pa.int32())})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double, predicted int")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    got = score(docs, learn(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic")))
    return got.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score", "predicted")
