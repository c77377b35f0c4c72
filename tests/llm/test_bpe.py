from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest

from fathomline.llm import bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
SCHEMA = "doc_id long, text string, ids int, sha string"


def expected(text):
    ids = bpe.encoding(PATH, PATTERN).encode_ordinary(text or "")
    return len(ids), hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def texts():
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("abcdefé ß'12  \n\n\t!?漢字") for _ in range(rnd.randint(1, 9)))
    long = " ".join(word() for _ in range(30_000))
    return [None, "", " ", "a", "it's  we'll\n\n  x", long, long, "x" * 50_000, " " * 40_000 + "y" + "\n" * 40_000, "ab " * 11_000 + "z" * 40_000 + " cd" * 30_000, "\U0001f600" * 20_000]


def test_matches_the_library(spark):
    rows = [(i, t, 1, "s") for i, t in enumerate(texts())] + [(None, "null id", None, None), (1, "", 2, None), (5, texts()[5], 1, "s")]
    got = bpe.digests(spark.createDataFrame(rows, SCHEMA), PATH, PATTERN).collect()
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(map(tuple, got), key=key) == sorted(((i, *expected(t)) for i, t, *_ in rows), key=key)


def test_empty_table(spark):
    assert bpe.digests(spark.createDataFrame([], SCHEMA), PATH, PATTERN).collect() == []


@pytest.mark.parametrize("piece", [b"a", b"aaaaaaaaaaaaaaaaaaaaaaa", "straßenbahnähnlich".encode(), b"  \n\n  ", bytes(range(256))])
def test_own_merge_is_the_librarys(piece):
    assert bpe.merge(piece, bpe.ranks(PATH)) == bpe.encoding(PATH, PATTERN)._core_bpe.encode_single_piece(piece)
