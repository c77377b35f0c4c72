from __future__ import annotations

import random
import re

import pytest

from fathomline.llm import decontam

DOCS, ITEMS = "doc_id long, text string, item_id string, s int, h int", "item_id long, text string, doc_id string, q int"


def shingles(text):
    w = re.findall(r"[^\W_]+", (text or "").lower())
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(docs, items):
    out = {}
    for d, t in docs:
        for i, u in items:
            s = shingles(u)
            n = len(s & shingles(t))
            if s and 100 * n >= 80 * len(s):
                out[d, i] = max(out.get((d, i), (0, 0, 0)), (n / len(s), n, len(s)))
    return sorted(((d, i, m, n, c) for (d, i), (c, n, m) in out.items()), key=str)


@pytest.mark.parametrize("limit", [10**6, 0])
def test_against_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(decontam, "BROADCAST_ROWS", limit)
    rnd = random.Random(5)
    text = lambda n: " ".join(rnd.choice("abcdefghijklmnop") * 2 for _ in range(n))
    items = [(i, text(n)) for i, n in enumerate([5, 6, 9, 20, 33, 64, 100, 3])] + [(100, None), (101, " .,"), (102, "Éa bb-cc, dd ee"), (None, "null item of five words")]
    items.append((103, items[3][1]))
    docs = []
    for i, u in items:
        for cut_off in (0, 1, 3, 10, 25):
            w = (u or "").upper().split()
            docs.append((len(docs), f"{text(40)}. {'; '.join(w[: len(w) - cut_off])}\n{text(500)}"))
        docs.append((len(docs), u))
    docs += [(None, items[2][1]), (3, items[4][1]), (7777, None), (7778, ""), (7779, "aa " * 30_000 + items[5][1]), (3, items[4][1])]
    a = spark.createDataFrame([(*r, "x", 1, 2) for r in docs], DOCS)
    b = spark.createDataFrame([(*r, "x", 1) for r in items], ITEMS)
    got = sorted(map(tuple, decontam.contamination(a, b).collect()), key=str)
    assert got == brute(docs, items) and len(got) > 20


def test_empty(spark):
    a, b = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    some = spark.createDataFrame([(1, "a b c d e f", "", 1, 1)], DOCS)
    assert decontam.contamination(a, b).collect() == [] and decontam.contamination(some, b).collect() == []
    assert decontam.contamination(a, some.select(some.doc_id.alias("item_id"), "text")).collect() == []


def test_both_sides_are_sketched_and_containment_is_estimated(spark):
    rnd = random.Random(9)
    text = lambda n: " ".join(str(rnd.randrange(10**6)) for _ in range(n))
    items = [(i, text(120)) for i in range(12)]
    docs = [(i, text(2000) + " " + (u if i % 2 else " ".join(u.split()[:108])) + " " + text(3000)) for i, u in items]
    a, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    sketched = decontam.sketches(b)
    size = {r.doc_id: r["count"] for r in decontam.document_sketches(a, sketched).groupBy("doc_id").count().collect()}
    assert all(0 < size[d] < 0.6 * len(shingles(t)) for d, t in docs)
    found = {(r.doc_id, r.item_id): r.estimate for r in decontam.candidates(a, b).collect()}
    assert set(found) == {(i, i) for i, _ in items}
    for i, u in items:
        true = len(shingles(u) & shingles(dict(docs)[i])) / len(shingles(u))
        assert abs(found[i, i] - true) < 0.2 and (true < 1 or found[i, i] == 1)
