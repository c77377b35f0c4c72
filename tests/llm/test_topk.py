from __future__ import annotations

import math
import random

import numpy as np
import pytest

from fathomline.llm import topk

SCHEMA = "vec_id long, embedding array<float>, score string, rank int"


def brute(queries, rows, k=10):
    ok = lambda v: v is not None and all(x is not None and math.isfinite(x) for x in v)
    whole = lambda v: [math.floor(1024 * x) for x in v]
    rows = [(i, whole(v)) for i, v in rows if i is not None and ok(v)]
    out = []
    for q, v in sorted({i: min(whole(v) for j, v in queries if j == i and ok(v)) for i, v in queries if i is not None and ok(v)}.items()):
        top = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in rows if i != q and len(w) == len(v))[:k]
        out += [(q, r, i, -s) for r, (s, i) in enumerate(top, 1)]
    return out


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_BYTES", 200)
    rnd = random.Random(1)
    rows = [(i, [rnd.choice([-0.5, 0.0, 0.25, 0.125]) for _ in range(4)]) for i in range(700)]
    rows += [(1000, None), (1100, []), (1101, []), (1102, []), (1200, [None, 1.0, 1.0, 1.0]), (1300, [float("nan"), 0.0, 0.0, 0.0]), (None, [1.0] * 4), (1400, [1.0, 2.0]), (7, rows[7][1]), (200, rows[200][1])]
    df = spark.createDataFrame([(*r, "s", 0) for r in rows], SCHEMA).repartition(5)
    got = topk.search(df.where("vec_id % 100 = 0"), df).collect()
    assert sorted(map(tuple, got)) == sorted(brute([r for r in rows if r[0] is not None and r[0] % 100 == 0], rows))


def test_large_components_stay_exact(spark):
    rows = [(i, [2.0**21 + i, 3.0]) for i in range(0, 300, 50)]
    df = spark.createDataFrame([(*r, "s", 0) for r in rows], SCHEMA)
    assert sorted(map(tuple, topk.search(df, df, k=3).collect())) == sorted(brute(rows, rows, 3))


@pytest.mark.parametrize("rows", [[], [(0, [1.0], "s", 1)]])
def test_nothing_to_find(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    assert topk.search(df, df).collect() == []


@pytest.mark.parametrize("own", [0, 3, 11, 40, 60])
def test_rows_of_the_query_take_no_places_of_the_cut(own):
    """With its id many times in a tile, the k best others are found all the same."""
    rnd = np.random.default_rng(own)
    query = np.array([[8.0, 8.0, 8.0]])
    tiles = [(np.r_[np.full(own, 7), np.arange(100, 163 - own)], np.r_[np.repeat(query, own, axis=0), rnd.integers(-8, 8, (63 - own, 3)).astype(float)]), (np.arange(200, 230), rnd.integers(-8, 8, (30, 3)).astype(float))]
    running = topk.Running(np.array([7]), query, 10)
    for ids, vectors in tiles:
        running.tile(ids, vectors)
    others = [(-float(query[0] @ v), int(i)) for ids, vectors in tiles for i, v in zip(ids, vectors, strict=True) if i != 7]
    assert sorted(zip((-running.score).tolist(), running.found.tolist(), strict=True)) == sorted(others)[:10]


def test_own_rows_in_one_tile_and_scores_beyond_a_long(spark):
    rows = [(7, [8.0, 8.0])] * 5 + [(i, [float(i % 9), 1.0]) for i in range(20, 60)]
    df = spark.createDataFrame([(*r, "s", 0) for r in rows], SCHEMA).coalesce(1)
    assert sorted(map(tuple, topk.search(df.where("vec_id = 7"), df).collect())) == sorted(brute([(7, [8.0, 8.0])], rows))
    huge = spark.createDataFrame([(i, [3e38 * s, 1.0], "s", 0) for i, s in ((1, 1.0), (2, 0.5), (3, -1.0))], SCHEMA)
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in topk.search(huge, huge).collect()}
    assert got[1, 1] == (2, 2**63 - 1) and got[1, 2] == (3, -(2**63)) and len(got) == 6


def test_settings_are_given_back(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    topk.search(df := spark.createDataFrame([(1, [1.0], "s", 0)], SCHEMA), df)
    assert spark.conf.get(name) == str(topk.batches.__globals__["BATCH_ROWS"])
