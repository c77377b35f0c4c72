"""Token counts of the best unigram segmentation, by dynamic programming over a trie.

Every token of a byte-level vocabulary has a score, the logarithm of a Zipf probability of its rank; a pre-token is cut
into the tokens of highest total score (of equal totals the fewest tokens). The forward score of a prefix depends on
the prefix alone, so distinct pre-tokens are inserted into a trie, each node holding the best score and token count of
its prefix: shared prefixes are computed once, and a pre-token's count is read at its last node. Scores are whole
numbers (millionths of a nat), so results do not depend on the order of sums.

Every task keeps one trie for the pre-tokens of its rows. One over the whole corpus would need each pair of a document and
a distinct pre-token of it to be shuffled twice, several times the texts themselves; a task's rows repeat their words
often enough. A trie of more than NODES nodes and known words is begun anew before the next batch, which changes no
result. Pre-tokens of more than LONG bytes are not kept: they run through a rolling table of the same recurrence, as
long as the longest token.

Defined cases: a null or empty text has no pre-tokens and no tokens; repeated rows are counted each; a null id stays; an
empty table gives none; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from operator import mul

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomline.llm import bpe
from fathomline.llm.common import batches, table

#: Nodes and words of a worker's trie, bytes of a pre-token that still goes into it, and the offset of the Zipf ranks.
NODES, LONG, OFFSET = 400_000, 256, 2


def scores(path: str) -> dict[bytes, int]:
    """Token to score; every byte is a token, so every text can be cut."""
    ranks = bpe.ranks(path)
    whole = math.log(sum(1 / (r + OFFSET) for r in ranks.values()))
    return {token: round(1e6 * (-math.log(rank + OFFSET) - whole)) for token, rank in ranks.items()}


class Trie:
    """Prefixes of pre-tokens with their forward scores; children by (node, byte)."""

    def __init__(self, score: dict[bytes, int]) -> None:
        # Every end of a token, with the score of those that are tokens: what is no end of one, no longer piece can be.
        self.ends: dict[bytes, int | None] = {token[k:]: None for token in score for k in range(1, len(token))} | score
        self.reach = max(map(len, score)) + 1
        self.clear()

    def clear(self) -> None:
        self.child: dict[tuple[int, int], int] = {}
        self.best: list[tuple[int, int]] = [(0, 0)]  # score, minus the number of tokens
        self.counts: dict[str, int] = {}

    def forward(self, word: bytes, best: list[tuple[int, int]], stop: int) -> tuple[int, int]:
        """Best cut of word[:stop], given those of all shorter prefixes."""
        ends, found = self.ends, None
        for start in range(stop - 1, -1, -1):
            piece = word[start:stop]
            if piece not in ends:
                break
            value = ends[piece]
            if value is not None:
                before, tokens = best[start]
                made = (before + value, tokens - 1)
                if found is None or made > found:
                    found = made
        assert found is not None
        return found

    def long(self, word: bytes) -> int:
        """Tokens of a pre-token that is not stored; only as much of the table is held as a token can reach back."""
        reach = self.reach
        best, base = [(0, 0)], 0  # best[i] is for word[:base + i]
        for stop in range(1, len(word) + 1):
            if len(best) > 4 * reach:
                base, best = base + len(best) - reach, best[-reach:]
            best.append(self.forward(word[base : stop], best, stop - base))
        return -best[-1][1]

    def count(self, text: str) -> int:
        """Tokens of a pre-token; stored at its end."""
        known = self.counts.get(text)
        if known is not None:
            return known
        word = text.encode()
        if len(word) > LONG:
            return self.long(word)
        node, path = 0, [(0, 0)]
        for stop, byte in enumerate(word, 1):
            there = self.child.get((node, byte))
            if there is None:
                there = self.child[node, byte] = len(self.best)
                self.best.append(self.forward(word, path, stop))
            path.append(self.best[there])
            node = there
        self.counts[text] = -path[-1][1]
        return self.counts[text]


def _counter(path: str, pattern: str):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, split = Trie(scores(path)), bpe.splitter(pattern)
        for part in parts:
            found = [Counter(split.findall(t.as_py() or "")) for t in part.column("text")]
            # New ones sorted, so that neighbours share prefixes. The trie is begun anew between batches only.
            if len(trie.best) + len(trie.counts) > NODES:
                trie.clear()
            new = sorted(set().union(*found).difference(trie.counts))
            long = {word: n for word in new if (n := trie.count(word)) and word not in trie.counts}
            look = (lambda w, kept=trie.counts, long=long: long[w] if w in long else kept[w]) if long else trie.counts.__getitem__
            totals = [sum(map(mul, c.values(), map(look, c))) for c in found]
            yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "n_pretokens": pa.array([c.total() for c in found], pa.int64()), "n_tokens": pa.array(totals, pa.int64())})

    return run


def token_counts(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_pretokens, n_tokens of every row."""
    batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_counter(path, pattern), "doc_id long, n_pretokens long, n_tokens long")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
