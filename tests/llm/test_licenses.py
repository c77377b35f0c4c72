from __future__ import annotations

import re

import pytest

from fathomline.llm import licenses as lic

TEXTS = [
    None, "", "cc by", "CC-BY CC BY cc by-nc", "All rights  reserved. General Public\nLicense all RIGHTS reserved", "xcc by", "é cc by", "Released under the MIT License.",
    "Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 3.", "This work is licensed under the GNU General Public License, version 3.", "Licensed under CC BY-NC 4.0.", "word " * 30_000 + "all rights reserved",
]


def brute(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    at = [(i, label) for phrase, label in lic.BASE.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in at]
    return len(words), len(at), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in at}))


def test_base_phrases(spark):
    df = spark.createDataFrame([(i, t, 7, "x") for i, t in enumerate(TEXTS)] + [(None, "cc by", 1, "x"), (3, TEXTS[3], 1, "x")], "doc_id long, text string, n_words int, labels string")
    got = lic.licenses(df).collect()
    assert len(got) == len(TEXTS) + 2
    for r in got:
        assert tuple(r[1:6]) == brute("cc by" if r.doc_id is None else TEXTS[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
    assert lic.licenses(df.limit(0)).collect() == []


def expand(source):
    """Wordings of a template: each optional part in and out, each listed variable wording, in turn."""
    m = re.search(r"<<beginOptional>>((?:(?!<<beginOptional>>|<<endOptional>>).)*)<<endOptional>>", source)
    if m:
        return {x for inside in ("", m[1]) for x in expand(source[: m.start()] + inside + source[m.end() :])}
    m = re.search(r"<<var;[^;]*;([^>]*)>>", source)
    if m:
        options = ["some", "1"] if re.fullmatch(r"\d+,\d+", m[1]) else m[1].split("|")
        return {x for o in options for x in expand(source[: m.start()] + o + source[m.end() :])}
    return {" ".join(source.split())}


@pytest.mark.parametrize("name", lic.TEMPLATES)
def test_templates_accept_their_wordings_and_no_other(name):
    wordings = expand(lic.TEMPLATES[name])
    few = sorted(wordings, key=lambda w: (len(w), w))
    for wording in few[:10] + few[-10:]:
        words = wording.split()
        assert (name, 2, 2 + len(words)) in lic.scan(f"Some text. {wording.upper()}; more")[7]
    pattern = re.compile(lic.as_pattern(lic.TEMPLATES[name]))
    first = few[0].split()
    for i in range(len(first)):
        for broken in ([*first[:i], *first[i + 1 :]], [*first[:i], "zzz", *first[i:]], [*first[:i], "zzz", *first[i + 1 :]]):
            got = name in lic.scan(" ".join(broken))[5].split(",")
            assert got == bool(pattern.search(f" {' '.join(broken)} "))
            # Words may be added at both ends, and elsewhere only where the template leaves it free.
            assert not got or len(first) < 12 or i in (0, len(first) - 1) or re.search(r"\d+,\d+", lic.TEMPLATES[name])


@pytest.mark.parametrize("name", ["mit", "bsd", "isc", "apache-2.0", "zlib", "unlicense"])
def test_a_changed_disclaimer_is_refused(name):
    wording = max(expand(lic.TEMPLATES[name]), key=len)
    assert name in lic.scan(wording)[5].split(",")
    for word, other in (("warranties", "promises"), ("warranty", "promise"), ("liable", "responsible"), ("law", "rule")):
        if re.search(rf"\b{word}\b", wording):
            assert name not in lic.scan(re.sub(rf"\b{word}\b", other, wording))[5].split(",")


def test_spans_limits_and_markup_in_front():
    auto = lic.compile_template("start <<var;x;2,3>> stop <<beginOptional>>now<<endOptional>>")
    match = lambda t: auto.match(lic.words(t), 0)
    assert [match(t) for t in ("start a stop", "start a b stop", "start a b c stop now x", "start a b c d stop", "start stop stop stop")] == [None, 4, 6, None, 4]
    front = lic.compile_template("<<beginOptional>>the<<endOptional>> <<var;x;0,2>> <<var;y;open|very open>> free license <<beginOptional>>text<<endOptional>>")
    assert (front.anchor, front.lead) == ((b"free", b"license"), 5)
    assert [front.match(lic.words(t), 0) for t in ("open free license", "the a b very open free license text", "the a b c open free license")] == [3, 8, None]
    with pytest.raises(ValueError):
        lic.compile_template("<<var;x;0,1>> <<beginOptional>>license<<endOptional>>")


def test_the_stretch_that_begins_first_counts():
    (mit,) = (w for w in expand(lic.TEMPLATES["mit"]) if w.startswith("the mit license copyright some permission") and "next paragraph" not in w and "authors or copyright" in w)
    spans = [s for s in lic.scan(f"x y {mit} z")[7] if s[0] == "mit"]
    assert spans == [("mit", 2, 2 + len(mit.split()))]
