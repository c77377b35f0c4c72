from __future__ import annotations

import hashlib
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))

import corpus_pipeline as cp
import test_bpe
import test_decontam
import test_linededup
import test_ngramjoin

SF = "/root/testdata/sf0.001"


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_every_stage_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before, sizes = rows(docs), [docs.count()]
    for k, (name, stage) in enumerate(cp.STAGES):
        out = stage(spark, docs, SF)
        if k < 4:
            assert out.columns == cp.COLUMNS
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        after = rows(docs)
        ids = sorted(before)
        if name == "language_id":
            assert set(after) == {i for i in ids if any(c.isalpha() for c in before[i].text or "")}
        elif name == "line_dedup":
            want = test_linededup.brute([before[i].text for i in ids], 10)
            assert {i: r.text for i, r in after.items()} == {i: w[0] for i, w in zip(ids, want, strict=True)}
            assert all(r.n_chars == len(r.text) for r in after.values())
        elif name == "ngram_join":
            assert set(after) == {i for i, _, c in test_ngramjoin.brute([(i, before[i].text) for i in ids]) if i == c}
        elif name == "decontamination":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            assert set(after) == set(ids) - {p[0] for p in test_decontam.brute([(i, before[i].text) for i in ids], items)}
        else:
            assert {i: tuple(r)[1:] for i, r in after.items()} == {i: test_bpe.expected(before[i].text) for i in ids}
        before = after
        sizes.append(len(after))
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0
    assert rows(cp.run(spark, SF)) == before
    assert hashlib.sha256(b"").hexdigest() not in {r.decoded_sha256 for r in before.values()} or any(r.n_tokens == 0 for r in before.values())


def test_odd_rows(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    some = [(1, "the house is old and big", "en", None, None), (1, "the house is old and big", "en", None, None), (None, "the road is long and wide", "en", "s", 1), (2, None, None, None, None), (3, "", None, None, 0), (6, "das haus ist alt", "de", "s", 3), (7, "the old house is big", "en", "s", 3)]
    for n, data in enumerate((some, [])):
        docs = spark.createDataFrame(data, schema)
        for name, stage in cp.STAGES:
            stage(spark, docs, SF).write.parquet(str(tmp_path / f"{n}{name}"))
            docs = spark.read.parquet(str(tmp_path / f"{n}{name}"))
        assert sorted((r.doc_id is None, r.doc_id) for r in docs.collect() if r.doc_id is not None) == ([(False, 1), (False, 6), (False, 7)] if data else [])
        assert docs.count() == (4 if data else 0)


def test_near_duplicates_take_five_words_and_four_fifths(spark):
    """Sets of 5 words at 0.80: a copy with a fifth added goes, one below the threshold stays."""
    base, schema = [f"w{k}" for k in range(100)], "doc_id long, text string, lang string, source string, n_chars long"
    texts = [" ".join(base), " ".join(base + [f"x{k}" for k in range(20)]), " ".join(base + [f"y{k}" for k in range(40)]), *(t for t in test_ngramjoin.corpus(4) if t)]
    data = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    sets = []
    for t in texts:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t).replace("\t", " ").replace("\n", " ").split(" ")
        w = [x for x in w if x]
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                x, y = root[i], root[j]
                root = [min(x, y) if r in (x, y) else r for r in root]
    got = set(rows(cp.drop_near_duplicates(spark, spark.createDataFrame(data, schema), SF)))
    assert got == {i for i, r in enumerate(root) if i == r} and 1 not in got and 2 in got


def test_lettered_texts_stay_without_labelled_languages(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    data = [(1, "the house is old", None, "s", 16), (2, "12 34 !", None, "s", 7), (3, None, None, None, None), (4, "", None, "s", 0), (None, "ein haus", None, "s", 8)]
    out = cp.identify_language(spark, spark.createDataFrame(data, schema), SF)
    assert out.columns == cp.COLUMNS and {r.doc_id for r in out.collect()} == {1, None}


def test_repeated_ids_null_ids_and_clashing_columns(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    schema = "doc_id long, text string, lang string, source string, n_chars long, mark long, gone long, component_id long, h1 int, part int, row int, _id long, _text string, lang_pred int, score int"
    rest = (1, 2, 3, 4, 5, 6, 7, "t", 8, 9)
    data = [(None, f"the old house {item}", "en", "s", 1, *rest), (None, "the old house stands by the road", "en", "s", 1, *rest), (5, "b one text of this id", "en", "s", 1, *rest), (5, "a quite different text has it too", "en", "s", 1, *rest), (6, f"and {item}", "en", None, None, *rest)]
    docs = spark.createDataFrame(data, schema)
    clean = cp.decontaminate(spark, docs, SF)
    assert clean.columns == cp.COLUMNS and sorted((r.doc_id or 0, r.text) for r in clean.collect()) == sorted((d[0] or 0, d[1]) for d in data[1:4])
    one = cp.drop_near_duplicates(spark, docs, SF)
    assert one.columns == cp.COLUMNS and {r.text for r in one.collect() if r.doc_id == 5} == {data[3][1]} and one.where("doc_id is null").count() == 2
    for _, stage in cp.STAGES:
        assert stage(spark, docs, SF).count() <= len(data)


def test_run_leaves_nothing_behind(spark):
    from fathomline.llm.common import shared_path

    left = lambda: {p.name for p in Path(shared_path(spark, "x").removeprefix("file:")).parent.iterdir() if not p.name.startswith("rdd-")}
    before = left()
    assert cp.run(spark, SF).count() > 0 and left() == before


def test_very_long_texts(spark):
    words = " ".join(f"word{k % 7001} of{k % 13}" for k in range(40_000))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(1, words, "en", "s", 1), (2, words + " end", "en", "s", 1), (3, "x" * 400_000, "en", "s", 1), (4, "a\n" * 50_000 + "b", "en", "s", 1)], schema)
    for _, stage in cp.STAGES[:-1]:
        docs = stage(spark, docs, SF)
    assert sorted(r.doc_id for r in docs.collect()) == [1, 3, 4]
    got = rows(cp.encode(spark, docs, SF))
    assert {i: tuple(r)[1:] for i, r in got.items()} == {r.doc_id: test_bpe.expected(r.text) for r in docs.collect()}
