"""Byte-level BPE encoding and decoding with overlapping chunks.

A text of more than CHUNK code points is cut into chunks that overlap. The chunks are pre-tokenised in parallel, each
from its own start. The pre-token pattern looks only ahead, so two runs of it that meet at one boundary agree from
there on; the first boundary that a chunk and its successor share inside their overlap is where they are stitched.
The pieces between stitches are then encoded in parallel and put together in order. Where an overlap holds no shared
boundary (one pre-token longer than the overlap), the rest of that text stays one piece, so the result is exact for
every text. Decoding concatenates the raw bytes of the ids.

Defined cases: a null or empty text has no tokens; repeated rows are encoded each; a null id stays null; an input
without rows gives none; columns other than the two named are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomline.llm.common import batches, release

#: Code points of a chunk's own part, and of the part that it shares with its successor.
CHUNK, OVERLAP = 1 << 15, 1 << 11
#: A boundary is trusted if this many code points follow before the white space at the chunk's end: no alternative of
#: the pattern looks further than over one run of white space and two more characters.
MARGIN = 4
#: Pieces (pre-tokens) longer than this many bytes are merged here with a heap, as the library's merge is quadratic.
LONG_PIECE = 4096

ENCODED = "doc_id long, n_tokens long, ids binary"


@lru_cache(maxsize=4)
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@lru_cache(maxsize=4)
def encoding(path: str, pattern: str):
    import tiktoken

    return tiktoken.Encoding("fathomline", pat_str=pattern, mergeable_ranks=ranks(path), special_tokens={})


@lru_cache(maxsize=4)
def vocabulary(path: str) -> list[bytes]:
    by_rank = {rank: token for token, rank in ranks(path).items()}
    return [by_rank.get(rank, b"") for rank in range(max(by_rank) + 1)]


@lru_cache(maxsize=4)
def splitter(pattern: str):
    import regex

    return regex.compile(pattern)


def merge(piece: bytes, rank: dict[bytes, int]) -> list[int]:
    """BPE of one piece: always the lowest-ranked adjacent pair, leftmost first. A heap over a linked list."""
    import heapq

    n = len(piece)
    if piece in rank:
        return [rank[piece]]
    end, left, right = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    alive = [True] * n
    heap = [(rank[piece[i : i + 2]], i, i + 2) for i in range(n - 1) if piece[i : i + 2] in rank]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = right[i] if alive[i] else n
        if j >= n or end[j] != stop:
            continue
        alive[j], end[i], right[i] = False, stop, right[j]
        if right[i] < n:
            left[right[i]] = i
        for a in (left[i], i):
            b = right[a] if a >= 0 else n
            if a >= 0 and b < n and (pair := piece[a : end[b]]) in rank:
                heapq.heappush(heap, (rank[pair], a, end[b]))
    out, i = [], 0
    while i < n:
        out.append(rank[piece[i : end[i]]])
        i = right[i]
    return out


def encode_text(text: str, path: str, pattern: str) -> list[int]:
    """Ids of a text that starts at a pre-token boundary."""
    library = encoding(path, pattern)
    if len(text) <= LONG_PIECE // 4:
        return library.encode_ordinary(text)
    out: list[int] = []
    start = 0
    for match in splitter(pattern).finditer(text):
        if match.end() - match.start() > LONG_PIECE // 4:
            out += library.encode_ordinary(text[start : match.start()])
            out += merge(match.group().encode(), ranks(path))
            start = match.end()
    return out + library.encode_ordinary(text[start:])


def _long_run(text: str) -> bool:
    """Whether a pre-token might be long: such a text has no white space, or nothing else, for a long stretch."""
    step = LONG_PIECE // 8
    return any((part := text[i : i + step]).isspace() or not any(map(str.isspace, part)) for i in range(0, len(text), step))


def encode_piece(text: str, path: str, pattern: str) -> list[int]:
    if len(text) > LONG_PIECE // 8 and _long_run(text):
        return encode_text(text, path, pattern)
    return encoding(path, pattern).encode_ordinary(text)


def boundaries(text: str, first: int, last: bool, pattern: str) -> tuple[list[int], list[int]]:
    """Trusted pre-token ends of a chunk, as positions in the whole text: in its head and in its tail overlap."""
    limit = len(text) if last else len(text.rstrip()) - MARGIN
    ends = [m.end() for m in splitter(pattern).finditer(text)]
    ends = [e for e in ends if e <= limit]
    return [first + e for e in ends if e < OVERLAP], [first + e for e in ends if e >= CHUNK]


def _le32(ids: list[int]) -> bytes:
    import numpy as np

    return np.asarray(ids, dtype="<u4").tobytes()


def _encoder(path: str, pattern: str, names: list[str]):
    """Batches with a text column: the text gives way to n_tokens and ids."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            ids = [_le32(encode_piece(t.as_py() or "", path, pattern)) for t in part.column("text")]
            kept = [part.column(n) for n in names]
            counts = pa.array([len(x) // 4 for x in ids], pa.int64())
            yield pa.RecordBatch.from_arrays([*kept, counts, pa.array(ids, pa.binary())], names=[*names, "n_tokens", "ids"])

    return run


def _pretokeniser(pattern: str):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = [
                boundaries(t.as_py(), i.as_py() * CHUNK, last.as_py(), pattern)
                for t, i, last in zip(part.column("text"), part.column("i"), part.column("last"), strict=True)
            ]
            lists = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(part.column(n) for n in ("doc_id", "sha", "i")), pa.array([f[0] for f in found], lists), pa.array([f[1] for f in found], lists)],
                names=["doc_id", "sha", "i", "head", "tail"],
            )

    return run


def stitches(long: DataFrame, pattern: str) -> DataFrame:
    """(doc_id, sha, cuts): the positions at which each long text may be cut, in order, from 0."""
    n = F.greatest(F.lit(1), F.ceil((F.length("text") - OVERLAP) / CHUNK)).cast("int")
    chunk = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.struct(i.alias("i"), (i == n - 1).alias("last"), F.col("text").substr(i * CHUNK + 1, F.when(i == n - 1, F.length("text")).otherwise(F.lit(CHUNK + OVERLAP))).alias("text")),
    )
    chunks = long.select("doc_id", "sha", F.explode(chunk).alias("c")).select("doc_id", "sha", "c.*")
    spread = chunks.repartition(F.col("doc_id"), F.col("sha"), F.col("i"))
    found = spread.mapInArrow(_pretokeniser(pattern), "doc_id long, sha string, i int, head array<long>, tail array<long>")
    whole = found.groupBy("doc_id", "sha").agg(F.sort_array(F.collect_set(F.struct("i", "head", "tail"))).alias("c"))
    meet = F.transform(
        F.sequence(F.lit(1), F.size("c") - 1),
        lambda i: F.array_min(F.array_intersect(F.col("c")[i - 1]["tail"], F.col("c")[i]["head"])),
    )
    meet = F.when(F.size("c") > 1, meet).otherwise(F.array().cast("array<long>"))
    # Behind the first overlap without a shared boundary nothing is proven any more.
    gap = F.array_position(F.transform("meet", lambda m: m.isNull()), F.lit(True))
    proven = F.when(gap > 0, F.slice("meet", F.lit(1), (gap - 1).cast("int"))).otherwise(F.col("meet"))
    return whole.select("doc_id", "sha", meet.alias("meet")).select("doc_id", "sha", F.concat(F.array(F.lit(0).cast("long")), proven).alias("cuts"))


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """doc_id, n_tokens and ids (little-endian unsigned 32-bit integers, as one binary) of every row.

    With `decoded` the ids' bytes as well; what is encoded in one piece is then decoded by the same worker.
    """
    batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    is_long = F.length("text") > CHUNK + OVERLAP
    encoder, decoder = _encoder(path, pattern, ["doc_id"]), _decoder(path, ("doc_id", "n_tokens", "ids"))
    if decoded:
        short = rows.where(~is_long).mapInArrow(lambda parts: decoder(encoder(parts)), ENCODED + ", decoded binary")
    else:
        short = rows.where(~is_long).mapInArrow(encoder, ENCODED)

    long = rows.where(is_long).withColumn("sha", F.sha2("text", 256))
    cuts = stitches(long, pattern).select(F.col("doc_id").alias("cut_id"), F.col("sha").alias("cut_sha"), "cuts")
    joined = long.join(cuts, F.col("doc_id").eqNullSafe(F.col("cut_id")) & (F.col("sha") == F.col("cut_sha")))
    piece = F.transform(
        "cuts",
        lambda cut, k: F.struct(
            cut.alias("start"),
            F.col("text").substr((cut + 1).cast("int"), (F.coalesce(F.get("cuts", k + 1), F.length("text").cast("long")) - cut).cast("int")).alias("text"),
        ),
    )
    pieces = joined.select("doc_id", "sha", F.explode(piece).alias("p")).select("doc_id", "sha", "p.*").repartition("doc_id", "sha", "start")
    coded = pieces.mapInArrow(_encoder(path, pattern, ["doc_id", "sha", "start"]), "doc_id long, sha string, start long, n_tokens long, ids binary")
    once = coded.groupBy("doc_id", "sha", "start").agg(F.first("n_tokens").alias("n_tokens"), F.first("ids").alias("ids"), F.count("*").alias("copies"))
    whole = once.groupBy("doc_id", "sha").agg(
        F.sum("n_tokens").alias("n_tokens"), F.sort_array(F.collect_list(F.struct("start", "ids"))).alias("parts"), F.max("copies").cast("int").alias("copies")
    )
    ids = F.unhex(F.array_join(F.transform("parts", lambda p: F.hex(p["ids"])), ""))
    again = F.explode(F.array_repeat(F.lit(0), F.col("copies")))
    put = whole.select("doc_id", "n_tokens", ids.alias("ids"), again.alias("copy")).drop("copy")
    return short.unionByName(decode(put, path) if decoded else put)


def _decoder(path: str, keep: tuple[str, ...]):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        token = vocabulary(path).__getitem__
        for part in parts:
            raw = [b"".join(map(token, np.frombuffer(x.as_py(), "<u4").tolist())) for x in part.column("ids")]
            yield pa.RecordBatch.from_arrays([*(part.column(n) for n in keep), pa.array(raw, pa.binary())], names=[*keep, "decoded"])
        release()

    return run


def decode(encoded: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id", "n_tokens", "ids")) -> DataFrame:
    """Adds the raw bytes of the ids, as decoded."""
    kinds = dict(encoded.dtypes)
    return encoded.select(*keep).mapInArrow(_decoder(path, keep), ", ".join(f"{n} {kinds[n]}" for n in keep) + ", decoded binary")


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    coded = encode(docs, path, pattern, decoded=True)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
