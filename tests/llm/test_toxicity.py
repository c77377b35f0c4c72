from __future__ import annotations

import numpy as np
import pytest

from fathomline.llm import toxicity as tox

SF = "/root/testdata/sf0.1"
SCHEMA = "doc_id long, text string, score string, toxic string"


def char_model(words):
    count = np.zeros((tox.LETTERS,) * 3)
    for word in words:
        ids = [0, 0, *map(tox.letter_id, word), 0]
        for a, b, c in zip(ids, ids[1:], ids[2:], strict=False):
            count[a, b, c] += 1
    return tox.CharModel.from_counts(count)


MODEL = char_model(["idiot", "moron", "the", "house", "trash", "loser", "good", "book", "or", "in", "a", "and"] * 200)


@pytest.mark.parametrize(("span", "clean"), [("1d10t", "idiot"), ("i d i o t", "idiot"), ("m.o.r.o.n", "moron"), ("idiiiiot", "idiot"), ("tr@sh", "trash"), ("l0$er", "loser"), ("house", "house"), ("gooood", "good"), ("m0-r0n", "moron")])
def test_decoding(span, clean):
    assert tox.decode(span, MODEL).strip() == clean


def test_decoding_is_the_cheapest_path():
    """Against all paths of the lattice."""

    def paths(span, i=0):
        if i == len(span):
            yield 0.0, ""
            return
        for written, stop, cost in tox.arcs(span, i):
            for more, rest in paths(span, stop):
                yield cost + more, written + rest

    def cost(text):
        total, x, y = 0.0, 0, 0
        for c in map(tox.letter_id, text):
            if c or y:
                total -= float(MODEL.log_p[x, y, c])
                x, y = y, c
        return total - float(MODEL.log_p[x, y, 0]) * (y > 0)

    for span in ("1d10t", "a 1 b", "mmm0r*n", "t-r-4-s-h"):
        best = min(c + cost(t) for c, t in paths(span))
        text = tox.decode(span, MODEL)
        assert min(c + cost(t) for c, t in paths(span) if t == text) == pytest.approx(best, abs=1e-4)


def test_held_out(spark):
    docs = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic")
    got = tox.op2_toxicity(spark, SF).join(docs, "doc_id").where("held_out").collect()
    hit = [r for r in got if r.toxic == 1]
    assert len(hit) >= 50 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    # Some documents of this table are labelled toxic though nothing in them is (label noise).
    assert sum(r.predicted for r in hit) / len(hit) > 0.85
    assert sum(r.predicted for r in got if r.toxic == 0) <= 0.005 * len(got)


def test_obfuscated_words_are_restored_and_scored(spark):
    words = ["river", "house", "green", "walk", "stone", "paper", "light", "water"]
    text = lambda i: " ".join(words[(i * k + k) % 8] for k in range(1, 9))
    rows = [(i, text(i) + (" you idiot" if i % 4 == 1 else ""), "x", "y") for i in range(400)]
    new = [(1000, "what an 1d10t you are", "", ""), (1001, "such an i d i o t there", "", ""), (1002, "green river house", "", ""), (1003, None, "", ""), (1004, "", "", ""), (None, "idiiiot", "", ""), (1005, "x" * 5000 + " " + "a. " * 3000, "", ""), (1000, "what an 1d10t you are", "", "")]
    labels = spark.createDataFrame([(i, int(i % 4 == 1), "z") for i in range(400)] + [(1, None, "z"), (None, 1, "z"), (1, 0, "z")], "doc_id long, toxic int, text string")
    df = spark.createDataFrame(rows + new, SCHEMA)
    got = tox.score(df, tox.learn(df, labels)).collect()
    assert len(got) == len(rows) + len(new)
    by = {r.doc_id: r.predicted for r in got}
    assert [by[i] for i in (1000, 1001, 1002, 1003, 1004, None, 1005)] == [1, 1, 0, 0, 0, 1, 0]
    assert all(by[i] == int(i % 4 == 1) for i in range(400))


def test_nothing_to_learn(spark):
    df = spark.createDataFrame([(1, "some text", "", "")], SCHEMA)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [tuple(r) for r in tox.score(df, tox.learn(df, none)).collect()] == [(1, 0.0, 0)]
    assert tox.score(df.limit(0), tox.learn(df.limit(0), none)).collect() == []


@pytest.mark.parametrize(("token", "word"), [("|diot", "idiot"), ("(1d10t", "idiot"), ("!diot!!!", "idiot"), ("tra$h", "trash"), ("tras#", "trash"), ("iiddiioott", "idiot"), ("mmoorroonn", "moron"), ("idiot###", "idiot"), ("book", "book"), ("good!", "good")])
def test_signs_at_the_ends_and_doubled_letters(token, word):
    assert word in tox.Restorer(MODEL).of_token(token)


def test_long_spans_are_decoded_whole():
    """No word is lost where the span was once cut; settling changes nothing."""
    span = " ".join("idiot" * 120)
    assert "".join(tox.Restorer(MODEL).restored(span)) == "idiot" * 120
    mixed = "-".join("1d10t m0r0n tr@sh".replace(" ", "") * 30)
    longest, tox.LONGEST = tox.LONGEST, 10**9
    try:
        want = tox.decode(mixed, MODEL)
    finally:
        tox.LONGEST = longest
    assert tox.decode(mixed, MODEL) == want


def test_words_that_travel_with_copies_displace_none(spark, monkeypatch):
    """A copied document has more features than are weighed at once, each in more documents than the toxic word."""
    monkeypatch.setattr(tox, "CANDIDATES", 20)
    long = " ".join(chr(97 + k % 26) * 1 + chr(97 + k // 26) + "q" + chr(97 + (k * 7) % 26) for k in range(60))
    rows = [(i, long if i % 3 == 1 else f"house {'bastard' if i % 12 == 2 else 'river'} green w{i}", "", "") for i in range(600)]
    labels = spark.createDataFrame([(i, int(i % 3 == 1 or i % 12 == 2)) for i in range(600)], "doc_id long, toxic int")
    df = spark.createDataFrame(rows, SCHEMA)
    got = tox.score(df, tox.learn(df, labels)).collect()
    assert all(r.predicted == int(r.doc_id % 3 == 1 or r.doc_id % 12 == 2) for r in got)


def test_a_word_across_the_old_cut_of_a_long_span_is_whole():
    words = tox.Restorer(MODEL).restored(" ".join("the" + "idiot" * 60))
    assert set(words) <= {"the", "idiot", "theidiot"} and words.count("idiot") >= 59


def test_words_of_letters_are_read_as_the_lattice_reads_them():
    """The short way for letters with up to three doubles, against the whole lattice."""
    rnd = np.random.default_rng(3)
    words = ["book", "moorron", "iiddiot", "goodd", "looser", "aabb", "ttrash", "hhousse", "llooss"]
    words += ["".join(c * int(n) for c, n in zip(rnd.choice(list("aemnorst"), 7), rnd.choice([1, 1, 2], 7), strict=True)) for _ in range(300)]
    for word in words:
        if tox._THRICE.search(word):
            continue
        places = [m.start() for m in tox._REPEAT.finditer(word)]
        assert tox.decode(word, MODEL) == word
        if places:
            assert tox.undouble(word, places, MODEL) == tox.decode(word, MODEL, True)
            assert sorted(set(tox.Restorer(MODEL).restored(word))) == sorted({word, tox.decode(word, MODEL, True)}) or tox.Restorer(MODEL).restored(word) == [word, tox.decode(word, MODEL, True)]


def test_trigrams_of_texts_one_behind_the_other():
    import pyarrow as pa

    texts = ["ab c", None, "", "x", "Straße é", "aa"]
    want = np.zeros(tox.LETTERS**3, np.int64)
    for text in texts:
        ids = [0, 0, *(int(tox.code_points()[ord(c)]) for c in text or ""), 0]
        for a, b, c in zip(ids, ids[1:], ids[2:], strict=False):
            want[(a * tox.LETTERS + b) * tox.LETTERS + c] += 1
    (got,) = tox._count_trigrams(iter([pa.RecordBatch.from_pydict({"text": pa.array(texts[:4])}), pa.RecordBatch.from_pydict({"text": pa.array(texts[4:])})]))
    assert dict(zip(got["code"].to_pylist(), got["n"].to_pylist(), strict=True)) == {int(k): int(want[k]) for k in np.flatnonzero(want)}
