"""N-gram Jaccard join with prefix filters under several global token orders.

A document is the set of its distinct shingles of `words` words (64-bit hashes). Documents with equal sets form a class,
of which the smallest id stands for all. If two sets reach the threshold, then under any total order of all tokens
their first tokens (a prefix whose length follows from the sizes) share one. Three orders are used: by how common a
token's hash bucket is in the corpus, rare first, ties by hash; by coarse commonness, ties by another hash; by coarser
commonness, ties by a third. The buckets are counted over all documents in a table of fixed size; any order is right,
these keep passages that many documents share out of the prefixes. Candidates must share a prefix token, at positions
that still allow the threshold, under the first order, and one under each other order, before the sets themselves are
compared.

Only components are wanted, so a group of documents that share a prefix token is not expanded into its pairs. In each
of STARS rounds every class is compared with one leader, the document of the group with the fewest rarer tokens (an
unedited original, if there is one); groups that have become one component are done. What is left in groups of several
components is then compared in full, across components only, so that no link between components is lost.

Tokens of buckets that hold HOT times the mean are hot: their groups may hold a large part of the corpus, so leaders are
found by an aggregate that combines before the shuffle and joined back, never by gathering the group; all others are
led by a window. In the full comparison a token's rows are dealt to slices of at most SLICE rows.

Every step is stored in the shared folder and read back, so plans stay short and a lost executor costs one step.

Defined cases: rows that share an id are one document (the row with the smallest set fingerprint), returned once for
each row; rows with a null id are returned with a null component and link with nothing, as do texts without words
(their component is their own id); an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fathomline.llm.common import Scratch, batches, cut, join_groups, release, table
from fathomline.llm.components import components

#: Words of a shingle, and the threshold in hundredths, where a caller names no others.
WORDS, PERCENT = 4, 85
#: Bits of the table of bucket counts (4 bytes each are broadcast), rounds of stars before the rest is compared in full.
BUCKET_BITS, STARS = 18, 2
#: Rows of two or three numbers that are broadcast at most; more are joined by shuffling.
BROADCAST_PAIRS = 250_000
#: Classes of equal sets that are broadcast at most, the largest first.
LARGE_CLASSES = 50_000
#: A bucket is hot above this many times the mean, so that no more than one in so many is; rows of a token in a slice.
HOT, SLICE = 8, 1000
#: Bytes of text that are hashed at once.
PORTION = 1 << 20

_LOWERED = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_ODD, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


#: White space that parts words.
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def _stir(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _ODD
    x = (x ^ (x >> np.uint64(27))) * _MIX
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts behind each other, and how many words each text has.

    A word's hash is the sum of its bytes, each times a random odd-looking number of its place, stirred.
    """
    sizes = np.fromiter((len(t or b"") + 1 for t in texts), np.int64, len(texts))
    raw = np.frombuffer(b"\n".join(t or b"" for t in texts).translate(_LOWERED) + b"\n", np.uint8)
    solid = ~_SPACE[raw]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    per_text = np.diff(np.searchsorted(np.flatnonzero(first), np.concatenate([[0], np.cumsum(sizes)])))
    letters, begins = raw[solid], np.flatnonzero(first[solid])
    if not len(begins):
        return np.zeros(0, np.uint64), per_text
    place = np.arange(len(letters)) - np.repeat(begins, np.diff(np.append(begins, len(letters))))
    with np.errstate(over="ignore"):
        factor = _stir(np.arange(1, int(place.max()) + 2, dtype=np.uint64) * _ODD) | np.uint64(1)
        return _stir(np.add.reduceat((letters.astype(np.uint64) + np.uint64(1)) * factor[place], begins)), per_text


def runs(texts: list[bytes | None], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all texts behind each other (not yet distinct), and how many each text has.

    A text of fewer words than a shingle has one, made of all of them.
    """
    h, sizes = word_hashes(texts)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    counts = np.where(sizes >= words, sizes - words + 1, np.minimum(sizes, 1))
    with np.errstate(over="ignore"):

        def mix(parts: list[np.ndarray]) -> np.ndarray:
            out = np.full(len(parts[0]), len(parts), np.uint64)
            for part in parts:
                out = out * _ODD + part
                out = (out ^ (out >> np.uint64(29))) * _MIX
            return out ^ (out >> np.uint64(32))

        n = max(0, len(h) - words + 1)
        every = mix([h[k : k + n] for k in range(words)])
        full, short = np.flatnonzero(sizes >= words), np.flatnonzero((sizes > 0) & (sizes < words))
        # Shingles that begin in the last words of a text would run into the next one.
        turn = np.zeros(len(h) + 1, np.int64)
        np.add.at(turn, starts[full], 1)
        np.add.at(turn, starts[full] + counts[full], -1)
        inside = every[np.cumsum(turn[:-1])[:n] > 0]
        out, at = np.zeros(int(counts.sum()), np.uint64), np.concatenate([[0], np.cumsum(counts)])
        alone = np.zeros(len(out), bool)
        alone[at[short]] = True
        out[~alone] = inside
        for i in short:
            out[at[i]] = mix([h[starts[i] + k : starts[i] + k + 1] for k in range(sizes[i])])[0]
        return out, counts


def portions(texts: list[bytes | None]) -> Iterator[list[bytes | None]]:
    """Texts in portions of about PORTION bytes: hashing takes some 40 bytes of memory for each."""
    held: list[bytes | None] = []
    size = 0
    for text in texts:
        held.append(text)
        size += len(text or b"")
        if size >= PORTION:
            yield held
            held, size = [], 0
    if held:
        yield held


def sets_of(texts: list[bytes | None], words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    out: list[np.ndarray] = []
    for portion in portions(texts):
        every, counts = runs(portion, words)
        out += [np.unique(x) for x in np.split(every, np.cumsum(counts)[:-1])]
    return out


def need(x, y, percent: int = PERCENT):
    """Least number of shared tokens of sets of these sizes (works on columns and on numbers)."""
    total = percent * (x + y)
    if isinstance(x, Column):
        return F.ceil(total / F.lit(100.0 + percent))
    return -(-total // (100 + percent))


def prefix(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1 if n else 0


def orders(tokens: np.ndarray, common: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, list[np.ndarray]]:
    """The prefix under the first order (hashes), and under the others (16 bits of hashes: these only filter)."""
    k = prefix(len(tokens), percent)
    if not k:
        return tokens, [tokens.astype(np.int16)] * 2
    count = common[tokens >> np.uint64(64 - BUCKET_BITS)].astype(np.uint64)
    ranks = rank_of(tokens, common)
    first = np.argpartition(ranks, k - 1)[:k]
    first = first[np.argsort(ranks[first])]
    coarse = np.log2(count + np.uint64(1)).astype(np.uint64)
    others = []
    for shift, step in ((31, 0), (27, 1)):
        with np.errstate(over="ignore"):
            other = (tokens ^ (tokens >> np.uint64(shift))) * _MIX
        # Commonness above, 56 bits of hash below tell tokens apart that are equally common.
        rank = ((coarse >> np.uint64(step)) << np.uint64(56)) | (other >> np.uint64(8))
        others.append(np.unique((other[np.argpartition(rank, k - 1)[:k]] >> np.uint64(24)).astype(np.uint16)).view(np.int16))
    return tokens[first], others


def fingerprint(tokens: np.ndarray) -> tuple[int, int]:
    digest = np.frombuffer(hashlib.md5(tokens.tobytes(), usedforsecurity=False).digest(), "<i8")
    return int(digest[0]), int(digest[1])


def rank_of(tokens: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Places under the first order, as far as numbers of 64 bits can tell them."""
    return (common[tokens >> np.uint64(64 - BUCKET_BITS)].astype(np.uint64) << np.uint64(32)) | (tokens & np.uint64(0xFFFFFFFF))


def possible(x: np.ndarray, y: np.ndarray, n: int, m: int, common: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether sets of n and m tokens with these first prefixes can reach the threshold.

    Below the smaller of the prefixes' last places both sets are known in full: what only one of them holds there is
    missing in the other.
    """
    a, b = rank_of(x, common), rank_of(y, common)
    end = min(a[-1], b[-1])
    x, y = x[a < end], y[b < end]
    both = len(np.intersect1d(x, y, assume_unique=True))
    least = need(n, m, percent)
    return n - (len(x) - both) >= least and m - (len(y) - both) >= least


def _filter(shared, percent: int):
    """Pairs that all orders let through, with what tells the documents' texts from others."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            sizes = part.column("n_a").to_pylist(), part.column("n_b").to_pylist()
            held = {c: tuple(part.column(f"{c}_{side}") for side in "ab") for c in "pqr"}
            right = []
            for k in range(part.num_rows):
                x, y = ({c: held[c][side][k].values.to_numpy() for c in "pqr"} for side in (0, 1))
                every = all(np.isin(x[c], y[c]).any() for c in "qr")
                right.append(every and possible(x["p"].view(np.uint64), y["p"].view(np.uint64), sizes[0][k], sizes[1][k], shared.value, percent))
            yield part.select(["a", "b", "f_a", "f_b"]).filter(pa.array(right, pa.bool_()))

    return run


def _texts(part: pa.RecordBatch) -> list[bytes | None]:
    return part.column("text").cast(pa.binary()).to_pylist()


def _count(words: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << BUCKET_BITS, np.int64)
        for part in parts:
            for portion in portions(_texts(part)):
                every, _ = runs(portion, words)
                total += np.bincount((every >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), minlength=len(total))
        release()
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(at, pa.int32()), "n": pa.array(total[at], pa.int64())})

    return run


def bucket_counts(docs: DataFrame, words: int = WORDS) -> np.ndarray:
    """How many shingles of all documents fall into each bucket: a table of fixed size, over all rows."""
    rows = docs.select("text").mapInArrow(_count(words), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(1 << BUCKET_BITS, np.int64)
    out[rows["bucket"].to_numpy(dtype=np.int64)] = rows["n"].to_numpy(dtype=np.int64)
    del rows
    release()
    return np.minimum(out, np.iinfo(np.int32).max).astype(np.int32)


def _prefixes(shared, words: int, percent: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = shared.value
        hot = HOT * float(common.astype(np.int64).sum()) / len(common)
        for part in parts:
            sets = sets_of(_texts(part), words)
            marks, firsts = [fingerprint(s) for s in sets], [orders(s, common, percent) for s in sets]
            # The first order puts common buckets last: hot tokens end the prefix.
            cold = [int((common[p[0] >> np.uint64(64 - BUCKET_BITS)] <= hot).sum()) for p in firsts]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": part.column("doc_id"),
                    "f1": pa.array([m[0] for m in marks], pa.int64()),
                    "f2": pa.array([m[1] for m in marks], pa.int64()),
                    "n": pa.array([len(s) for s in sets], pa.int32()),
                    "cold": pa.array(cold, pa.int32()),
                    "p1": pa.array([p[0].view(np.int64) for p in firsts], pa.list_(pa.int64())),
                    "p2": pa.array([p[1][0] for p in firsts], pa.list_(pa.int16())),
                    "p3": pa.array([p[1][1] for p in firsts], pa.list_(pa.int16())),
                }
            )
        release()

    return run


def _sets(keep: list[str], words: int):
    """Rows of documents that stand for a class: their sets, if this row is the one meant."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            sets = sets_of(_texts(part), words)
            right = [fingerprint(s)[0] == f for s, f in zip(sets, part.column("f1").to_pylist(), strict=True)]
            columns = [part.column(k) for k in keep]
            whole = pa.RecordBatch.from_arrays([*columns, pa.array([s.tobytes() for s in sets], pa.binary())], names=[*keep, "s"])
            yield whole.filter(pa.array(right, pa.bool_()))
        release()

    return run


def _compare(percent: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            right = []
            for x, y in zip(part.column("s"), part.column("t"), strict=True):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                right.append(100 * both >= percent * (len(x) + len(y) - both))
            yield part.select(["a", "b"]).filter(pa.array(right, pa.bool_()))

    return run


class Join:
    def __init__(self, docs: DataFrame, scratch: Scratch, words: int = WORDS, percent: int = PERCENT) -> None:
        """docs: (doc_id, text)."""
        self.spark, self.docs, self.scratch, self.words, self.percent = docs.sparkSession, docs, scratch, words, percent
        batches(self.spark)

    def prepare(self) -> None:
        """sets, a row for each of docs; heads (f1, f2, cls, row, n, size), a row for each class; classes (cls, f1, n, cold, p1, p2, p3)."""
        store = self.scratch.store
        self.common = self.spark.sparkContext.broadcast(bucket_counts(self.docs, self.words))
        rows = self.docs.mapInArrow(_prefixes(self.common, self.words, self.percent), "doc_id long, f1 long, f2 long, n int, cold int, p1 array<long>, p2 array<smallint>, p3 array<smallint>")
        self.sets = store(rows.withColumn("row", F.monotonically_increasing_id()))
        one = self.sets.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(F.struct("f1", "f2", "n", "row")).alias("m"), F.count("*").alias("copies"))
        self.one = one.select("doc_id", "copies", "m.*")
        heads = self.one.groupBy("f1", "f2").agg(F.min(F.struct("doc_id", "row", "n")).alias("h"), F.count("*").alias("size"))
        self.heads = store(heads.select("f1", "f2", F.col("h.doc_id").alias("cls"), "h.row", "h.n", "size"))
        reps = self.heads.where("n > 0").select("cls", "row")
        self.classes = store(self.sets.join(reps, "row").select("cls", "f1", "n", "cold", "p1", "p2", "p3"))
        tokens = self.classes.select("cls", "n", "cold", F.posexplode("p1").alias("pos", "token"))
        cold = tokens.where("pos < cold").withColumn("held", F.count("*").over(Window.partitionBy("token"))).where("held > 1")
        # Two tables: rows whose token is rare enough to be gathered, dealt by token; and the rest, as they come.
        self.cold = cold.select("token", "pos", "cls", "n").persist(StorageLevel.DISK_ONLY)
        self.hot = tokens.where("pos >= cold").select("token", "pos", "cls", "n")

    def bounded(self, df: DataFrame) -> DataFrame:
        """Broadcast if its counted rows are few."""
        return F.broadcast(df) if df.count() <= BROADCAST_PAIRS else df

    def labelled(self, label: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        """cold and hot with each class's label."""
        if label is None:
            return self.cold.withColumn("comp", F.col("cls")), self.hot.withColumn("comp", F.col("cls"))
        known = self.bounded(label)
        return tuple(rows.join(known, F.col("cls") == F.col("node"), "left").select("token", "pos", "cls", "n", F.coalesce("comp", "cls").alias("comp")) for rows in (self.cold, self.hot))

    def allowed(self, n: str, pos: str, m: str, at: str) -> Column:
        """Whether a first shared token at these positions leaves room for the threshold."""
        least = need(F.col(n), F.col(m), self.percent)
        return (F.col(pos) <= F.col(n) - least) & (F.col(at) <= F.col(m) - least)

    def starred(self, label: DataFrame | None) -> DataFrame:
        """(a, b): every class with the leader that it shares most tokens with, of another label."""
        cold, hot = self.labelled(label)
        lead = F.min(F.struct("pos", "n", "cls", "comp"))
        led = [cold.withColumn("lead", lead.over(Window.partitionBy("token")))]
        leads = hot.groupBy("token").agg(lead.alias("lead"), F.count("*").alias("held")).where("held > 1").drop("held")
        led.append(hot.join(self.bounded(self.scratch.store(leads)), "token"))
        columns = ["pos", "n", F.col("cls").alias("a"), F.col("lead.cls").alias("b"), F.col("lead.n").alias("m"), F.col("lead.pos").alias("at")]
        led = reduce(DataFrame.union, [rows.where("comp <> lead.comp").select(*columns) for rows in led])
        # A class has at most a prefix of rows: dealt by class they are counted and ranked in one place.
        shared = led.where(self.allowed("n", "pos", "m", "at")).repartition("a").groupBy("a", "b").agg(F.count("*").alias("shared"))
        return shared.groupBy("a").agg(F.min(F.struct((-F.col("shared")).alias("less"), "b")).alias("best")).select("a", "best.b")

    def across(self, label: DataFrame | None) -> DataFrame:
        """(a, b): all pairs of classes of different labels that share a prefix token."""
        spans = lambda rows: rows.groupBy("token").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("held")).where("low < high")
        both = [(rows, spans(rows)) for rows in self.labelled(label)]
        parts = F.ceil(F.col("held") / SLICE).cast("int").alias("parts")
        wide = self.bounded(self.scratch.store(reduce(DataFrame.union, [s for _, s in both]).select("token", parts)))
        open_ = reduce(DataFrame.union, [rows.join(wide, "token") for rows, _ in both])
        left = open_.withColumn("slice", F.pmod(F.xxhash64("cls"), F.col("parts")).cast("int")).drop("parts")
        right = open_.select("token", F.col("pos").alias("at"), F.col("cls").alias("b"), F.col("n").alias("m"), F.col("comp").alias("comp_b"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("slice"))
        found = left.join(right, ["token", "slice"]).where((F.col("cls") > F.col("b")) & (F.col("comp") != F.col("comp_b")) & self.allowed("n", "pos", "m", "at"))
        return found.select(F.col("cls").alias("a"), "b").distinct()

    def verified(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) that all orders' prefixes let through and whose sets reach the threshold.

        Several a may share a b; its set travels once.
        """
        store = self.scratch.store
        pairs = store(pairs)
        side = lambda k: self.classes.select(F.col("cls").alias(k), *(F.col(c).alias(f"{n}_{k}") for c, n in (("f1", "f"), ("n", "n"), ("p1", "p"), ("p2", "q"), ("p3", "r"))))
        asked, marked = self.bounded(pairs), self.bounded(store(pairs.select("b").distinct()))
        both = side("a").join(asked, "a").join(side("b").join(marked, "b"), "b")
        columns = ["a", "b", *(f"{c}_{k}" for c in "fnpqr" for k in "ab")]
        likely = store(both.select(*columns).mapInArrow(_filter(self.common, self.percent), "a long, b long, f_a long, f_b long"))
        asked, marked = self.bounded(likely), self.bounded(store(likely.select("b", F.col("f_b").alias("f1")).distinct()))
        a = self.docs.join(asked, F.col("doc_id") == F.col("a")).select("a", "b", F.col("f_a").alias("f1"), "text").mapInArrow(_sets(["a", "b"], self.words), "a long, b long, s binary")
        b = self.docs.join(marked, F.col("doc_id") == F.col("b")).select("b", "f1", "text").mapInArrow(_sets(["b"], self.words), "b long, s binary")
        both = a.join(b.withColumnRenamed("s", "t"), "b").select("a", "b", "s", "t")
        return store(both.mapInArrow(_compare(self.percent), "a long, b long"))

    def links(self) -> DataFrame:
        """Enough links (a, b) between classes to connect every component."""
        found: list[DataFrame] = []
        label = None
        for turn in range(STARS):
            found.append(self.verified(self.starred(label)))
            label = components(reduce(DataFrame.union, found), self.scratch, rounds=turn + 1)
        found.append(self.verified(self.across(label)))
        return reduce(DataFrame.union, found)

    def result(self) -> DataFrame:
        """doc_id, n_shingles, component_id."""
        self.prepare()
        try:
            label = components(self.links(), self.scratch)
        finally:
            self.cold.unpersist()
        heads = self.heads.join(self.bounded(label), F.col("cls") == F.col("node"), "left").select("f1", "f2", "size", F.coalesce("comp", "cls").alias("comp"))
        heads = self.scratch.store(heads)
        members = join_groups(self.one, heads, ["f1", "f2"], "size", LARGE_CLASSES)
        # Equal sets are linked, unless they are empty.
        comp = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("comp"))
        rows = members.select("doc_id", F.col("n").cast("long").alias("n_shingles"), comp.alias("component_id"), F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("copy")).drop("copy")
        return rows.union(self.sets.where(F.col("doc_id").isNull()).select(F.lit(None).cast("long"), F.col("n").cast("long"), F.lit(None).cast("long")))


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, computed at once and kept by a checkpoint."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    with Scratch(docs.sparkSession, "ngram-join") as scratch:
        return cut(Join(rows, scratch, words, percent).result())


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents"))


OP6_SQL = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) >= {WORDS} THEN list_transform(range(1, len(w) - {WORDS} + 2), lambda i: array_to_string(w[i:i + {WORDS} - 1], ' '))
                                           WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS t FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.t = b.t AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * k >= {PERCENT} * (a.n + b.n - k)
), reach AS (SELECT doc_id AS id, doc_id AS r FROM documents UNION SELECT id, y FROM reach JOIN links ON x = r
)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.r AS component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT id, min(r) AS r FROM reach GROUP BY id) c ON c.id = d.doc_id
"""
