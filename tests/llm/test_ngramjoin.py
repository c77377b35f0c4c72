from __future__ import annotations

import random

import pytest

from fathomline.llm import ngramjoin

SCHEMA = "doc_id long, text string, component_id string, n int, cls string"


def brute(rows):
    chosen = {}
    for i, t in rows:
        words = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").replace("\x0b", " ").replace("\x0c", " ").replace("\t", " ").replace("\r", " ").replace("\n", " ").split(" ")
        words = [w for w in words if w]
        s = frozenset(tuple(words[k : k + 4]) for k in range(max(1, len(words) - 3))) if words else frozenset()
        chosen[i] = s
    comp = {i: i for i in chosen}

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    ids = sorted(chosen)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            a, b = chosen[i], chosen[j]
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                x, y = root(i), root(j)
                comp[max(x, y)] = min(x, y)
    return sorted((i, len(chosen[i]), root(i)) for i in ids)


def corpus(seed):
    rnd = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(60)]
    text = lambda n: [rnd.choice(vocabulary) for _ in range(n)]
    passage, rows = text(30), []
    for _ in range(12):
        base = text(rnd.choice([3, 8, 40, 120]))
        for _ in range(rnd.choice([1, 2, 15])):
            words = list(base)
            for _ in range(rnd.choice([0, 0, 1, 2, 4])):
                words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
            rows.append(" ".join(words))
    rows += [" ".join(text(20) + passage) for _ in range(15)]
    rows += [None, "", " \n ", "One", "one", "ONE ", "a b c", "a  b\tc", "b a c", "x y z w", "ä\xa0b c d e", "ä b c d e"]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize(("seed", "stars", "limit"), [(1, 2, 10**6), (2, 0, 10**6), (3, 1, 0)])
def test_against_brute_force(spark, monkeypatch, seed, stars, limit):
    monkeypatch.setattr(ngramjoin, "STARS", stars)
    monkeypatch.setattr(ngramjoin, "BROADCAST_PAIRS", limit)
    monkeypatch.setattr(ngramjoin, "LARGE_CLASSES", 3 if seed == 2 else 50_000)
    monkeypatch.setattr(ngramjoin, "SLICE", 2 if seed == 2 else 1000)
    monkeypatch.setattr(ngramjoin, "HOT", 1 if seed == 1 else 10**6)
    rows = list(enumerate(corpus(seed), 5))
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)
    assert sorted(map(tuple, ngramjoin.join(df).collect())) == brute(rows)


def test_null_ids_and_repeated_rows(spark):
    rows = [(None, "a b c d e"), (3, "a b c d e"), (3, "a b c d e"), (2, "A b c d e"), (9, "q r s t u v"), (None, None)]
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)
    got = sorted(map(tuple, ngramjoin.join(df).collect()), key=str)
    assert got == sorted([(None, 2, None), (None, 0, None), (3, 2, 2), (3, 2, 2), (2, 2, 2), (9, 3, 9)], key=str)


def test_empty(spark):
    assert ngramjoin.join(spark.createDataFrame([], SCHEMA)).collect() == []


def test_very_long_texts_and_clashing_columns(spark):
    rnd = random.Random(7)
    long = [f"w{rnd.randrange(10**6)}" for _ in range(60_000)]
    rows = [(1, " ".join(long)), (2, " ".join(long[:58_000])), (3, " ".join(long[:40_000])), (4, "x" * 300_000), (5, "x" * 300_000 + " y")]
    df = spark.createDataFrame([(*r, "a", 1, "b", 2, 3) for r in rows], "doc_id long, text string, component_id string, n int, cls string, row int, token int")
    assert sorted(map(tuple, ngramjoin.join(df).collect())) == brute(rows)


def test_groups_that_are_broadcast_and_joined(spark):
    from fathomline.llm.common import join_groups

    keys = [0] * 50 + [1] * 30 + list(range(2, 22))
    rows = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id long, k long")
    groups = rows.groupBy("k").count().withColumn("v", rows.k * 10)
    for most in (3, 1000):
        got = join_groups(rows, groups, ["k"], "count", most)
        assert sorted((r["id"], r["v"]) for r in got.collect()) == [(i, 10 * k) for i, k in enumerate(keys)]
