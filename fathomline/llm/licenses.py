"""License scans by template matching.

Templates are wording with two kinds of markup: <<beginOptional>> ... <<endOptional>> around words that may be missing,
and <<var;name;m,n>> for m to n words of any kind (or <<var;name;a b|c>> for one of some wordings). A template is
compiled into an automaton over words. Its anchor is its first run of mandatory words; the automaton is run from every
place from which the words before an occurrence of the anchor could be the markup before it. A text holds the template
if the automaton accepts: all mandatory words exactly, in order, with only the marked freedom. Of the stretches that
are accepted for one occurrence of the anchor the one that begins first counts, as far as it goes.

Words are runs of ASCII letters and digits and of everything outside ASCII, A-Z lower-cased. Beside the templates there
are base phrases, whose words must stand consecutively.

Defined cases: a null or empty text has no words, null places, empty labels and score 0; repeated rows are scanned
each; a null id stays; an empty table gives none; other columns are ignored. Score: 1 with a template, 0.5 with base
phrases only, else 0.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomline.llm.common import batches, table

# The base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Public license wordings, with markup.
TEMPLATES = {
    "mit-notice": "released under the <<beginOptional>>terms of the<<endOptional>> mit license",
    "apache-2.0-notice": "licensed under the apache license <<beginOptional>>version<<endOptional>> <<var;version;2 0|2>>",
    "gpl-notice": "licensed under the <<beginOptional>>terms of the<<endOptional>> <<beginOptional>>gnu<<endOptional>> general public license <<beginOptional>><<var;kind;version|v>> <<var;number;1,1>><<endOptional>>",
    "cc-by-nc-notice": "licensed under <<beginOptional>>a<<endOptional>> <<var;name;cc|creative commons>> <<var;terms;by nc|attribution noncommercial|attribution non commercial>> <<beginOptional>><<var;version;4 0|3 0|2 5|2 0>><<endOptional>>",
    "cc-by-notice": "licensed under <<beginOptional>>a<<endOptional>> <<var;name;cc|creative commons>> <<var;terms;by|attribution>> <<var;version;4 0|3 0|2 5|2 0>>",
    "mit": (
        "<<beginOptional>><<beginOptional>>the<<endOptional>> mit license<<endOptional>> <<beginOptional>>copyright <<var;holder;1,12>><<endOptional>> "
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
        "the software to deal in the software without restriction including without limitation the rights "
        "to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is "
        "furnished to do so subject to the following conditions the above copyright notice and this permission notice "
        "<<beginOptional>>including the next paragraph<<endOptional>> shall be included in all copies or substantial portions of the software "
        "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability "
        "fitness for a particular purpose and noninfringement in no event shall the <<var;who;authors or copyright holders|authors|copyright holders>> be liable "
        "for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with "
        "the software or the use or other dealings in the software"
    ),
    "isc": (
        "<<beginOptional>>isc license<<endOptional>> <<beginOptional>>copyright <<var;holder;1,12>><<endOptional>> "
        "permission to use copy modify <<var;and;and or|and>> distribute this software for any purpose with or without fee is hereby granted "
        "provided that the above copyright notice and this permission notice appear in all copies "
        "the software is provided as is and <<var;author;the author|isc>> disclaims all warranties with regard to this software including all implied "
        "warranties of merchantability and fitness in no event shall <<var;author;the author|isc>> be liable for any special direct indirect or "
        "consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or "
        "other tortious action arising out of or in connection with the use or performance of this software"
    ),
    "bsd": (
        "<<beginOptional>>copyright <<var;holder;1,12>> all rights reserved<<endOptional>> "
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met "
        "<<beginOptional>>1<<endOptional>> redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer "
        "<<beginOptional>>2<<endOptional>> redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer "
        "in the documentation and or other materials provided with the distribution "
        "<<beginOptional>><<beginOptional>>3<<endOptional>> neither the name of <<var;holder;1,20>> nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission<<endOptional>> "
        "this software is provided by the copyright <<var;who;holders|holder>> and contributors as is and any express or implied warranties including but not limited to "
        "the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall the copyright <<var;who;holder|holders|owner>> or "
        "contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute "
        "goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict "
        "liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage"
    ),
    "apache-2.0": (
        "<<beginOptional>>copyright <<var;holder;1,12>><<endOptional>> licensed under the apache license version 2 0 the license "
        "you may not use this file except in compliance with the license you may obtain a copy of the license at "
        "<<var;scheme;http|https>> www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is "
        "distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing "
        "permissions and limitations under the license"
    ),
    "gpl-header": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by "
        "the free software foundation <<beginOptional>>either<<endOptional>> version <<var;version;1,2>> <<beginOptional>>of the license<<endOptional>> "
        "<<beginOptional>>or at your option any later version<<endOptional>> this program is distributed in the hope that it will be useful but without any warranty "
        "without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details "
        "<<beginOptional>>you should have received a copy of the gnu general public license along with this program<<endOptional>>"
    ),
    "mpl-2.0-header": (
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file "
        "you can obtain one at <<var;scheme;http|https>> <<beginOptional>>www<<endOptional>> mozilla org mpl 2 0"
    ),
    "zlib": (
        "<<beginOptional>>copyright <<var;holder;1,12>><<endOptional>> this software is provided as is without any express or implied warranty in no event will the "
        "<<var;who;authors|author>> be held liable for any damages arising from the use of this software permission is granted to anyone to use this software for any purpose "
        "including commercial applications and to alter it and redistribute it freely subject to the following restrictions <<beginOptional>>1<<endOptional>> the origin of "
        "this software must not be misrepresented you must not claim that you wrote the original software if you use this software in a product an acknowledgment in the "
        "product documentation would be appreciated but is not required <<beginOptional>>2<<endOptional>> altered source versions must be plainly marked as such and must not "
        "be misrepresented as being the original software <<beginOptional>>3<<endOptional>> this notice may not be removed or altered from any source distribution"
    ),
    "unlicense": (
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software "
        "either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means in jurisdictions that recognize copyright laws "
        "the author or authors of this software dedicate any and all copyright interest in the software to the public domain we make this dedication for the benefit of "
        "the public at large and to the detriment of our heirs and successors we intend this dedication to be an overt act of relinquishment in perpetuity of all present "
        "and future rights to this software under copyright law the software is provided as is without warranty of any kind express or implied including but not limited "
        "to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors be liable for any claim damages or other "
        "liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software "
        "<<beginOptional>>for more information please refer to <<var;scheme;http|https>> <<beginOptional>>www<<endOptional>> unlicense org<<endOptional>>"
    ),
}

_WORDS = bytes(b | 0x20 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_MARK = re.compile(r"<<(beginOptional|endOptional|var;[^>]*)>>")


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_WORDS).split()


@dataclass
class Automaton:
    """States are numbers; `steps` maps a state and a word to states, `any` is a step by any word, `free` by none.

    `anchor` is the first run of mandatory words, `lead` the most words that can stand before it.
    """

    steps: list[dict[bytes, set[int]]] = field(default_factory=list)
    any: list[set[int]] = field(default_factory=list)
    free: list[set[int]] = field(default_factory=list)
    end: int = 0
    anchor: tuple[bytes, ...] = ()
    lead: int = 0

    def state(self) -> int:
        self.steps.append({})
        self.any.append(set())
        self.free.append(set())
        return len(self.free) - 1

    def chain(self, at: int, wording: list[bytes]) -> int:
        for word in wording:
            there = self.state()
            self.steps[at].setdefault(word, set()).add(there)
            at = there
        return at

    def reach(self, states: set[int]) -> set[int]:
        todo, out = list(states), set(states)
        while todo:
            for s in self.free[todo.pop()] - out:
                out.add(s)
                todo.append(s)
        return out

    def match(self, text: list[bytes], start: int) -> int | None:
        """End of the longest stretch from start that is accepted."""
        states, found, i = self.reach({0}), None, start
        while True:
            if self.end in states:
                found = i
            if not states or i >= len(text):
                return found
            states = self.reach({t for s in states for t in (*self.steps[s].get(text[i], ()), *self.any[s])})
            i += 1


def compile_template(source: str) -> Automaton:
    out = Automaton()
    at, opened, anchor, lead = out.state(), [], [], 0
    closed = False  # whether the anchor has ended
    for k, piece in enumerate(_MARK.split(source)):
        before = 0  # the most words that this piece adds before the anchor
        if k % 2 == 0:
            wording = words(piece)
            at = out.chain(at, wording)
            if opened or closed:
                before = len(wording)
            else:
                anchor += wording
        elif piece == "beginOptional":
            opened.append(at)
        elif piece == "endOptional":
            there = out.state()
            out.free[at].add(there)
            out.free[opened.pop()].add(there)
            at = there
        else:
            rule, there = piece.split(";", 2)[2], out.state()
            if span := re.fullmatch(r"(\d+),(\d+)", rule):
                before = int(span[2])
                for n in range(before):
                    if n >= int(span[1]):
                        out.free[at].add(there)
                    after = out.state()
                    out.any[at].add(after)
                    at = after
                out.free[at].add(there)
            else:
                wordings = [words(wording) for wording in rule.split("|")]
                before = max(map(len, wordings))
                for wording in wordings:
                    out.free[out.chain(at, wording)].add(there)
            at = there
        closed = closed or (k % 2 == 1 and bool(anchor))
        lead += 0 if anchor else before
    if opened or not anchor:
        raise ValueError("a template needs mandatory words, and every optional part an end")
    out.end, out.anchor, out.lead = at, tuple(anchor), lead
    return out


@cache
def automata() -> dict[str, Automaton]:
    return {name: compile_template(source) for name, source in TEMPLATES.items()}


def places(joined: bytes, phrase: bytes) -> list[int]:
    """Word positions at which a phrase's words stand, in words joined by blanks with one at each end."""
    out, at, seen, count = [], joined.find(b" " + phrase + b" "), 0, 0
    while at >= 0:
        count += joined.count(b" ", seen, at)
        seen = at
        out.append(count)
        at = joined.find(b" " + phrase + b" ", at + 1)
    return out


def scan(text: str | None) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score, and the templates' stretches."""
    found = words(text)
    joined = b" " + b" ".join(found) + b" "
    base = {label: at for phrase, label in BASE.items() if (at := places(joined, phrase.encode()))}
    starts = sorted(i for at in base.values() for i in at)
    spans = []
    for name, automaton in automata().items():
        for start in places(joined, b" ".join(automaton.anchor)):
            # The words before the anchor may be markup; `stop > start`: a stretch has the anchor in it.
            for first in range(max(0, start - automaton.lead), start + 1):
                if (stop := automaton.match(found, first)) is not None and stop > start:
                    spans.append((name, first, stop))
                    break
    labels = {*base, *(s[0] for s in spans)}
    score = 1.0 if spans else 0.5 if base else 0.0
    return (len(found), len(starts), starts[0] if starts else None, starts[-1] if starts else None, ",".join(sorted(base)), ",".join(sorted(labels)), score, sorted(spans, key=lambda s: (s[1], s[0])))


SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<label: string, first: long, stop: long>>"
_TYPES = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.float64(), pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("stop", pa.int64())]))]
_NAMES = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]


def _scan(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        rows = [scan(t.as_py()) for t in part.column("text")]
        columns = [pa.array([r[k] if k < 7 else [dict(zip(("label", "first", "stop"), s, strict=True)) for s in r[k]] for r in rows], kind) for k, kind in enumerate(_TYPES)]
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], names=["doc_id", *_NAMES])


def licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(_scan, SCHEMA)


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses(table(spark, sf_dir, "documents")).drop("spans")


def as_pattern(source: str) -> str:
    """A template as a regular expression over words that each follow a blank, with a blank at the end."""
    out = ""
    for k, piece in enumerate(_MARK.split(source)):
        wording = lambda x: "".join(f" {w.decode()}" for w in words(x))
        if k % 2 == 0:
            out += wording(piece)
        elif piece == "beginOptional":
            out += "(?:"
        elif piece == "endOptional":
            out += ")?"
        else:
            rule = piece.split(";", 2)[2]
            span = re.fullmatch(r"(\d+),(\d+)", rule)
            out += f"(?: [^ ]+){{{span[1]},{span[2]}}}" if span else f"(?:{'|'.join(map(wording, rule.split('|')))})"
    return out + " "


def _sql() -> str:
    phrases = {label: phrase.split() for phrase, label in sorted(BASE.items(), key=lambda x: x[1])}
    places_of = ", ".join(f"list_filter(range(len(w)), lambda i: w[i + 1:i + {len(p)}] = {p}) AS b{k}" for k, p in enumerate(phrases.values()))
    held = {label: f"len(b{k}) > 0" for k, label in enumerate(phrases)}
    found = {name: f"regexp_matches(j, '{as_pattern(source)}')" for name, source in TEMPLATES.items()}
    listed = lambda tests: "array_to_string(list_filter([" + ", ".join(f"CASE WHEN {t} THEN '{n}' END" for n, t in sorted(tests.items())) + "], lambda x: x IS NOT NULL), ',')"
    every = "list_concat(" * (len(phrases) - 1) + "b0" + "".join(f", b{k})" for k in range(1, len(phrases)))
    return f"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
), b AS (SELECT doc_id, w, ' ' || array_to_string(w, ' ') || ' ' AS j, {places_of} FROM w
), s AS (SELECT *, {every} AS places FROM b
), l AS (SELECT doc_id, w, places, {listed(held)} AS base_labels, {listed(held | found)} AS labels FROM s
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(places) AS BIGINT) AS n_base, CAST(list_min(places) AS BIGINT) AS first_word,
       CAST(list_max(places) AS BIGINT) AS last_word, base_labels, labels,
       CASE WHEN labels <> base_labels THEN 1.0::DOUBLE WHEN labels <> '' THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END AS score
FROM l
"""


OP7_SQL = _sql()
