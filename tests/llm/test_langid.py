from __future__ import annotations

import numpy as np

from fathomline.llm import langid

SF = "/root/testdata/sf0.01"


def test_model_equals_explicit_kernel_ridge():
    texts = [("the quick brown fox", "en"), ("the lazy dog sleeps", "en"), ("der schnelle braune fuchs", "de"), ("der faule hund schläft", "de"), ("the dog and fox", "en"), ("ein hund und fuchs", "de")]
    model = langid.fit(texts)
    grams = lambda t: {t.lower()[i : i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)}
    known = set().union(*(grams(t) for t, _ in texts))
    sets = [grams(t) & known for t, _ in texts]
    k = np.array([[len(a & b) / np.sqrt(len(a) * len(b)) for b in sets] for a in sets])
    y = np.array([[1 if x == lang else -1 for x in ("de", "en")] for _, lang in texts])
    # All texts are landmarks, so Nyström features are the whole kernel: f(x) = K (K K + r K)^-1 K y.
    alpha = np.linalg.solve(k @ k + langid.RIDGE * len(texts) * k, k @ y)
    new = grams("the fuchs dog")
    want = np.array([len(new & s) / np.sqrt(len(new & known) * len(s)) for s in sets]) @ alpha
    x, _ = model.presence(["the fuchs dog"])
    got = (x @ model.weights)[0] / np.sqrt(x.sum())
    assert np.allclose(got, want, atol=1e-3)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    got = langid.op9_language_id(spark, SF).join(docs, "doc_id").where("held_out").collect()
    assert len(got) > 100 and sum(r.lang == r.lang_pred for r in got) / len(got) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_edges(spark):
    rows = [(i, f"the house is {i} old and the road is long", "en", "x", 1.0, "y") for i in range(20)]
    rows += [(100 + i, f"das haus ist {i} alt und die straße ist lang", "de", "x", 1.0, "y") for i in range(20)]
    rows += [(200, None, "en", None, None, None), (201, "", "en", None, None, None), (202, "12 !? 34", None, None, None, None), (None, "the road is old", None, None, None, None), (203, "漢字", None, None, None, None), (0, rows[0][1], "en", "x", 1.0, "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string, score double, held_out string")
    out = langid.annotate(df, langid.learn(df))
    assert out.columns == ["doc_id", "text", "lang", "held_out", "lang_pred", "score"]
    got = out.collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert all(by[i].lang_pred == "en" for i in range(20)) and all(by[100 + i].lang_pred == "de" for i in range(20))
    assert [(by[i].lang_pred, by[i].score) for i in (200, 201, 202)] == [("und", 0.0)] * 3 and by[203].lang_pred in ("de", "en") and by[None].lang_pred == "en"


def test_nothing_to_learn(spark):
    df = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in langid.annotate(df, langid.learn(df)).collect()] == [("und", 0.0)]
    assert langid.annotate(df.limit(0), langid.learn(df.limit(0))).collect() == []


def test_rare_languages_are_learned(spark):
    """More languages than were once kept, the last ones with the fewest documents."""
    word = lambda k: "".join(chr(0x4E00 + 40 * k + j) for j in range(6))
    rows = [(i * 80 + k, f"{word(k)} {word(k)[::-1]} {i}", f"l{k:02}") for k in range(70) for i in range(3 + (k < 64))]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").where("crc32(cast(string(doc_id) as binary)) % 5 <> 0")
    assert langid.learn(df).languages == sorted({r.lang for r in df.collect()}) and df.where("lang >= 'l64'").count() > 0


def test_every_letter_of_three_scripts_counts():
    """More code points than have direct tables: the presence matrix still has every n-gram of the landmarks."""
    rnd = np.random.default_rng(1)
    word = lambda first, n: "".join(chr(first + int(k)) for k in rnd.integers(0, 400, n))
    texts = [(word(first, 60), lang) for lang, first in (("zh", 0x4E00), ("ko", 0xAC00), ("en", 0x61 - 0x41)) for _ in range(12)]
    model = langid.fit(texts)
    known = sorted(set().union(*(langid.spectrum(t).tolist() for t, _ in texts)))
    assert len({c for t, _ in texts for c in t}) > 3 * langid.ALPHABET and model.weights.shape[0] == len(known) + 1
    for text in [t for t, _ in texts[::5]] + [texts[0][0][:30] + "zz" + texts[20][0][:30], "\U0010ffff", ""]:
        x, _ = model.presence([text])
        assert set(np.flatnonzero(x[0])) == {1 + known.index(c) for c in langid.spectrum(text).tolist() if c in set(known)}
    assert [model.score([t])[0][0] for t, _ in texts] == [lang for _, lang in texts]


def test_ties_go_to_the_language_that_sorts_first():
    model = langid.fit([("abc abc", "y"), ("abc abc", "x"), ("abc abc", "z")])
    assert model.score(["abc", "qqq", "ABC " * 50_000])[0] == ["x"] * 3


def test_stretches_lose_no_gram(monkeypatch):
    text = "".join(chr(97 + int(k)) for k in np.random.default_rng(2).integers(0, 26, 500))
    whole = langid.spectrum(text)
    monkeypatch.setattr(langid, "STRETCH", 7)
    assert np.array_equal(langid.spectrum(text), whole) and len(langid.spectrum("ab")) == 3 and len(langid.spectrum("")) == 0
