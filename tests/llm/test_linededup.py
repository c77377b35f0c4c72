from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from fathomline.llm import linededup

SCHEMA = "doc_id long, text string, n_lines string, h1 int, line string"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))


def brute(texts, threshold, ids=None):
    """Rows with one id are one document; rows with none are their own."""
    split = [(t or "").split("\n") for t in texts]
    ids = range(len(texts)) if ids is None else [("row", k) if i is None else i for k, i in enumerate(ids)]
    count = Counter(k for k, _ in {(key(x), i) for lines, i in zip(split, ids, strict=True) for x in lines})
    common = {k for k, n in count.items() if k and n >= threshold}
    return [("\n".join(x for x in lines if key(x) not in common), len(lines), sum(key(x) in common for x in lines)) for lines in split]


TEXTS = [f"  Head ÄÖ \nbody {i % 4}\n\nfoot\t" for i in range(9)] + ["head äö \nFOOT", "HEAD ÄÖ \r\nfoot\nfoot", None, "", "\n", "\n\n x ", "x\nX\n\x0bx", "foot"] + ["only\n" * 5000 + "foot"]


@pytest.mark.parametrize("limit", [1_000_000, 0, 4])
@pytest.mark.parametrize("threshold", [2, 10])
def test_against_brute_force(spark, monkeypatch, limit, threshold):
    monkeypatch.setattr(linededup, "BROADCAST_LINES", limit)
    rows = [(i if i != 3 else None, t, "n", 1, "l") for i, t in enumerate(TEXTS)] + [(4, TEXTS[4], "n", 1, "l")]
    rows += [(50, f"again\nsame {i}", "n", 1, "l") for i in range(12)] + [(None, "nobody", "n", 1, "l")] * 12
    out = linededup.dedupe(spark.createDataFrame(rows, SCHEMA), threshold=threshold)
    assert out.columns == ["doc_id", "text", "h1", "line", "n_lines", "n_dropped"]
    got = sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in out.collect()), key=str)
    want = brute([r[1] for r in rows], threshold, [r[0] for r in rows])
    assert got == sorted(((r[0], *w) for r, w in zip(rows, want, strict=True)), key=str)


def test_batches_that_arrive_later_count(spark):
    runs = linededup.LineRuns(spark, threshold=4, fan=2)
    for k in range(5):
        runs.add(linededup.keys(spark.createDataFrame([(f"a\nb{k}",)], "text string")).withColumn("n", F.lit(1).cast("long")))
    assert sorted(level for level, _, _ in runs.runs) == [0, 2]
    assert runs.common().count() == 1
    runs.close()
    assert runs.runs == []


def test_empty(spark):
    assert linededup.dedupe(spark.createDataFrame([], SCHEMA)).collect() == []


def test_nothing_is_left_behind(spark):
    tables = len(spark.catalog.listTables())
    df = spark.createDataFrame([(i, "a\nb") for i in range(12)], "doc_id long, text string")
    assert linededup.dedupe(df).where("n_dropped = 2").count() == 12 and len(spark.catalog.listTables()) == tables
    with pytest.raises(RuntimeError), linededup.LineRuns(spark) as runs:
        runs.add(df.selectExpr("doc_id AS h1", "doc_id AS h2", "doc_id AS n"))
        raise RuntimeError
    assert len(spark.catalog.listTables()) == tables
