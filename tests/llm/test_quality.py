from __future__ import annotations

import numpy as np
import pytest

from fathomline.llm import quality as q

SF = "/root/testdata/sf0.1"
DOCS, LABELS = "doc_id long, text string, site string, host string, p int", "doc_id long, quality int, text string"


def test_held_out(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").groupBy("doc_id").max("quality")
    got = q.op3_quality(spark, SF).join(labels, "doc_id").where("held_out").toPandas()
    assert len(got) > 300 and got["score"].between(0, 1).all()
    y, s = got["max(quality)"].to_numpy(), got["score"].to_numpy()
    assert ((s >= 0.5) == (y == 1)).mean() > 0.95
    rank = s.argsort().argsort() + 1
    auc = (rank[y == 1].sum() - (y == 1).sum() * ((y == 1).sum() + 1) / 2) / ((y == 1).sum() * (y == 0).sum())
    assert auc > 0.95


def test_posteriors_by_hand(spark):
    rows = [(i, "Good plain text of words." if i % 3 else "$$$ ### %%%", f"h{i % 4}/p{i % 2}/x", "c", 1) for i in range(60)]
    labels = [(i, int(i % 3 > 0), "z") for i in range(60)] + [(1, None, "z"), (None, 1, "z")]
    docs, known = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)
    got = {r.doc_id: r for r in q.score(docs, known).collect()}
    model, rate = q.learn(docs, known)
    logit = {i: float(model.evidence(np.array([q.shape(t.encode())]))[0]) for i, t, *_ in rows}
    p = {i: 1 / (1 + np.exp(-(v + np.log(rate / (1 - rate))))) for i, v in logit.items()}
    host, path = {i: i % 4 for i in p}, {i: (i % 4, i % 2) for i in p}
    mean = sum(p.values()) / len(p)

    def strength(groups):
        between = sum(n * (s / n - m) ** 2 for n, s, m in groups)
        within, whole, n = sum(m * (1 - m) for _, _, m in groups), sum(n * m * (1 - m) for n, _, m in groups), sum(g[0] for g in groups)
        return min(q.STRONGEST, max(q.WEAKEST, whole / n / max((between - within) / n, 1e-9) - 1))

    def sums(key):
        out = {}
        for i, v in p.items():
            n, s = out.get(key[i], (0, 0.0))
            out[key[i]] = n + 1, s + v
        return out

    hosts, paths = sums(host), sums(path)
    a = strength([(n, s, mean) for n, s in hosts.values()])
    m = {h: (s + a * mean) / (n + a) for h, (n, s) in hosts.items()}
    b = strength([(n, s, m[h]) for (h, _), (n, s) in paths.items()])
    for i in p:
        h = (hosts[host[i]][1] - p[i] + a * mean) / (hosts[host[i]][0] - 1 + a)
        prior = (paths[path[i]][1] - p[i] + b * h) / (paths[path[i]][0] - 1 + b)
        assert got[i].prior == pytest.approx(prior, rel=1e-6)
        assert got[i].score == pytest.approx(1 / (1 + np.exp(-(logit[i] + np.log(prior / (1 - prior))))), rel=1e-6)


def test_edges(spark):
    rows = [(1, None, None, "c", 1), (2, "", "", "c", 1), (None, "x", "a", "c", 1), (2, "", "", "c", 1), (3, "long " * 40_000, "a/b/c/d", "c", 1)]
    docs, none = spark.createDataFrame(rows, DOCS), spark.createDataFrame([], LABELS)
    got = q.score(docs, none).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    assert q.score(docs.limit(0), none).collect() == []
