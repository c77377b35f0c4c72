from __future__ import annotations

import random
from functools import cache

import public_tokenizers
import regex

from fathomline.llm import tokencounts as tc

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def brute(text, score):
    longest = max(map(len, score))

    def tokens(word):
        @cache
        def best(i):
            return (0, 0) if i == len(word) else max((s + b[0], b[1] - 1) for j in range(i + 1, min(len(word), i + longest) + 1) if (s := score.get(word[i:j])) is not None for b in [best(j)])

        for i in range(len(word), -1, -1):
            best(i)
        return -best(0)[1]

    words = regex.findall(PATTERN, text or "")
    each = {w: tokens(w.encode()) for w in set(words)}
    return len(words), sum(map(each.get, words))


def test_against_recursion(spark, monkeypatch):
    monkeypatch.setattr(tc, "NODES", 50)
    rnd = random.Random(2)
    texts = [None, "", " ", "the", "straße ähnlich 漢字 \n\n x"] + ["".join(rnd.choice("theraion é1 .\n") for _ in range(200)) for _ in range(30)] + ["z" * 300, "the " * 40_000 + "é" * 5_000, "ab" * 4_000 + " " * 3_000 + "x"]
    rows = [(i, t, 1, "x") for i, t in enumerate(texts)] + [(None, "the", 1, "x"), (3, "the", 1, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, word string")
    score = tc.scores(PATH)
    got = sorted(map(tuple, tc.token_counts(df, PATH, PATTERN).collect()), key=str)
    assert got == sorted(((i, *brute(t, score)) for i, t, *_ in rows), key=str)
    assert tc.token_counts(df.limit(0), PATH, PATTERN).collect() == []


def test_a_shared_prefix_is_computed_once():
    trie = tc.Trie(tc.scores(PATH))
    trie.count(" national")
    nodes = len(trie.best)
    trie.count(" nation")
    assert len(trie.best) == nodes == len(" national") + 1
    trie.count(" nationality")
    assert len(trie.best) == nodes + 3


def test_long_words_are_not_kept():
    trie, score = tc.Trie(tc.scores(PATH)), tc.scores(PATH)
    for k in range(300):
        word = f"{k}" * 200 + "national" * 20
        assert trie.count(word) == -max_cut(word.encode(), score)
    assert trie.counts == {} and len(trie.best) == 1


def max_cut(word, score):
    longest, best = max(map(len, score)), [(0, 0)]
    for stop in range(1, len(word) + 1):
        best.append(max((best[i][0] + score[word[i:stop]], best[i][1] - 1) for i in range(max(0, stop - longest), stop) if word[i:stop] in score))
    return best[-1][1]
