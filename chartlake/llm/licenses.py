"""License scans: base phrases, and templates with optional and replaceable regions.

A template is a license's or notice's wording with markup in the manner of
published license lists::

    <<beginOptional>> ... <<endOptional>>     wording that may be missing
    <<var;name=work;match=work|program>>      one word of the given ones
    <<var;name=holder;words=0-40>>            any words, so many

It is compiled to a token automaton: a row of items (a word, one word of a
set, any word) with edges over what may be left out, its states the bits of
one whole number. A place of a text is accepted when all mandatory wording
stands there, word for word, in order. Automata are only run around the
template's anchor, its longest mandatory wording, found in a whole batch of
texts at once; from an anchor back there are only as many starts as the
regions before it leave open. A template's accepted places don't overlap: the
earliest start wins, and its longest form.

Words are maximal runs of a-z, 0-9 and non-ASCII characters, A-Z lowered.

Defined results: null and empty texts have no words, no labels and score 0; a
text is scanned whole, whatever its length; equal rows and null or repeated
ids are told apart, each row has its own result; an empty table gives no rows;
other columns than the id and the text aren't read.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .terms import byte_table, split
from .words import chunks

# The base phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Wording of public licenses and notices, with markup; the name is the label.
TEMPLATES = {
    "MIT": [
        """<<var;name=verb;match=released|licensed|distributed|available|published>> under the
        <<beginOptional>>terms of the<<endOptional>> MIT License""",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this
        <<var;name=work;match=software|work>> and associated documentation files (the "Software"), to deal in the
        Software without restriction, including without limitation the rights to use, copy, modify, merge, publish,
        distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is
        furnished to do so, subject to the following conditions: The above copyright notice and this permission
        notice <<beginOptional>>(including the next paragraph)<<endOptional>> shall be included in all copies or
        substantial portions of the Software.
        <<beginOptional>>THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,
        INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
        NONINFRINGEMENT. IN NO EVENT SHALL <<var;name=holder;words=1-20>> BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
        LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH
        THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.<<endOptional>>"""],
    "Apache-2.0": [
        """licensed under the <<beginOptional>>terms of the<<endOptional>> Apache License,
        <<beginOptional>>Version<<endOptional>> 2.0
        <<beginOptional>>(the "License"); you may not use this file except in compliance with the License. You may
        obtain a copy of the License at <<var;name=address;words=1-12>> Unless required by applicable law or agreed
        to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
        WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.<<endOptional>>"""],
    "GPL-3.0": [
        """licensed under the <<beginOptional>>terms of the<<endOptional>> <<beginOptional>>GNU<<endOptional>>
        General Public License, <<beginOptional>>version<<endOptional>> 3"""],
    "GPL-notice": [
        """This <<var;name=work;match=program|library|software|file>> is free software<<beginOptional>>: <<endOptional>>
        you can redistribute it and/or modify it under the terms of the GNU General Public License as published by
        the Free Software Foundation, either version <<var;name=version;words=1-2>>
        <<beginOptional>>of the License<<endOptional>>, or (at your option) any later version."""],
    "BSD-3-Clause": [
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided
        that the following conditions are met: <<beginOptional>>1.<<endOptional>> Redistributions of source code
        must retain the above copyright notice, this list of conditions and the following disclaimer.
        <<beginOptional>>2.<<endOptional>> Redistributions in binary form must reproduce the above copyright notice,
        this list of conditions and the following disclaimer in the documentation and/or other materials provided
        with the distribution. <<beginOptional>>3.<<endOptional>> Neither the name of
        <<var;name=holder;words=1-20>> nor the names of its contributors may be used to endorse or promote products
        derived from this software without specific prior written permission."""],
    "ISC": [
        """Permission to use, copy, modify, and<<beginOptional>>/or<<endOptional>> distribute this software for any
        purpose with or without fee is hereby granted, provided that the above copyright notice and this permission
        notice appear in all copies."""],
    "MPL-2.0": [
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL
        was not distributed with this file, You can obtain one at <<var;name=address;words=1-8>>"""],
    "CC-BY-NC": [
        """licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>Creative Commons<<endOptional>>
        <<var;name=terms;match=cc|attribution>> <<beginOptional>>BY<<endOptional>>
        <<var;name=terms;match=nc|noncommercial>> <<beginOptional>><<var;name=version;words=2-2>><<endOptional>>"""],
}

ANY = None
WORD = re.compile("[0-9a-z\x80-\U0010ffff]+")
MARK = re.compile("<<(.*?)>>", re.DOTALL)
#: Most words that a replaceable region may stand for.
WIDEST = 100


@dataclass(frozen=True)
class Automaton:
    """Items in a row; state ``s`` has read ``s`` of them, ``skips`` lead over what may be missing."""

    label: str
    items: tuple[frozenset[str] | None, ...]
    skips: tuple[tuple[int, int], ...]
    anchor: tuple[int, int]  # the anchor's items, from and to
    before: tuple[int, int]  # fewest and most words that may stand before it

    @functools.cached_property
    def reads(self) -> tuple[dict[str, int], int]:
        """For each word the items that read it, as bits; and those that read any word."""
        other = sum(1 << i for i, item in enumerate(self.items) if item is ANY)
        words = {w for item in self.items if item for w in item}
        return {w: other | sum(1 << i for i, item in enumerate(self.items) if item and w in item)
                for w in words}, other

    def closed(self, states: int) -> int:
        for start, stop in self.skips:  # in order of their starts, so one pass is enough
            if states >> start & 1:
                states |= 1 << stop
        return states

    def longest(self, words: list[str], start: int) -> int | None:
        """End of the longest accepted form that starts at ``start``, None if there is none."""
        reads, other = self.reads
        states, best, done = self.closed(1), None, 1 << len(self.items)
        for at in range(start, len(words)):
            states = self.closed((states & reads.get(words[at], other)) << 1)
            if not states:
                break
            if states & done:
                best = at + 1
        return best


def compile_template(label: str, markup: str) -> Automaton:
    """The automaton of one template."""
    items: list[frozenset[str] | None] = []
    skips: list[tuple[int, int]] = []
    fixed: list[bool] = []  # one mandatory word
    open_at: list[int] = []
    for i, piece in enumerate(MARK.split(markup)):
        if i % 2 == 0:
            found = [frozenset([w]) for w in WORD.findall(piece.lower())]
            items += found
            fixed += [not open_at] * len(found)
        elif piece == "beginOptional":
            open_at.append(len(items))
        elif piece == "endOptional":
            if not open_at:
                raise ValueError(f"{label}: endOptional without its start")
            start = open_at.pop()
            if start < len(items):
                skips.append((start, len(items)))
        elif piece.startswith("var;"):
            parts = dict(p.split("=", 1) for p in piece[4:].split(";"))
            if "match" in parts:
                items.append(frozenset(WORD.findall(parts["match"].lower())))
                fixed.append(False)
            else:
                low, high = (int(n) for n in parts["words"].split("-"))
                if not 0 <= low <= high <= WIDEST:
                    raise ValueError(f"{label}: a region takes from 0 to {WIDEST} words")
                skips += [(len(items) + j, len(items) + j + 1) for j in range(low, high)]
                items += [ANY] * high
                fixed += [False] * high
        else:
            raise ValueError(f"{label}: unknown markup {piece!r}")
    if open_at:
        raise ValueError(f"{label}: beginOptional without its end")
    # the longest run of mandatory words that no region can break
    inner = {e for skip in skips for e in skip}
    runs, start = [], None
    for i in range(len(items) + 1):
        if start is not None and (i == len(items) or not fixed[i] or i in inner):
            runs.append((start, i))
            start = None
        if i < len(items) and fixed[i] and start is None:
            start = i
    if not runs:
        raise ValueError(f"{label}: no mandatory wording")
    anchor = max(runs, key=lambda r: (r[1] - r[0], -r[0]))
    fewest = [0] * (anchor[0] + 1)  # by item, the least words read up to there
    for i in range(1, anchor[0] + 1):
        fewest[i] = min([fewest[i - 1] + 1] + [fewest[a] for a, b in skips if b == i])
    return Automaton(label, tuple(items), tuple(sorted(skips)), anchor, (fewest[-1], anchor[0]))


def compile_templates(templates: Mapping[str, list[str]]) -> list[Automaton]:
    return [compile_template(label, markup) for label, forms in templates.items() for markup in forms]


class _Words:
    """The words of a portion of texts, with the places of phrases in them."""

    def __init__(self, texts: pa.Array, table: np.ndarray) -> None:
        self.distinct, self.codes, self.offsets = split(texts, table)
        self.place = {w: i for i, w in enumerate(self.distinct.to_pylist())}
        self.often = np.bincount(self.codes, minlength=len(self.place))

    def places(self, phrase: list[str]) -> np.ndarray:
        """Where the words of ``phrase`` stand in a row within one text."""
        codes = [self.place.get(w) for w in phrase]
        if None in codes or not codes:
            return np.zeros(0, np.int64)
        rare = min(range(len(codes)), key=lambda i: self.often[codes[i]])
        starts = np.flatnonzero(self.codes == codes[rare]) - rare
        starts = starts[(starts >= 0) & (starts + len(codes) <= len(self.codes))]
        for i, code in enumerate(codes):
            starts = starts[self.codes[starts + i] == code]
        row = self.rows(starts)
        return starts[starts + len(codes) <= self.offsets[row + 1]]

    def rows(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offsets, places, side="right") - 1

    def of(self, row: int) -> list[str]:
        return self.distinct.take(pa.array(self.codes[self.offsets[row]:self.offsets[row + 1]])).to_pylist()


def _accepted(words: _Words, automata: list[Automaton]) -> dict[int, list[tuple[str, int, int]]]:
    """(label, first word, word behind the last) of the accepted places of each row that has some."""
    anchors: dict[int, list[tuple[int, np.ndarray]]] = {}
    for number, a in enumerate(automata):
        places = words.places([next(iter(item)) for item in a.items[slice(*a.anchor)]])
        rows = words.rows(places)
        for row in np.unique(rows):
            anchors.setdefault(int(row), []).append((number, places[rows == row] - words.offsets[row]))
    found: dict[int, list[tuple[str, int, int]]] = {}
    for row, met in anchors.items():
        text = words.of(row)
        for number, places in met:
            a, done = automata[number], 0
            for place in places.tolist():
                for start in range(max(done, place - a.before[1]), place - a.before[0] + 1):
                    stop = a.longest(text, start)
                    if stop is not None:
                        found.setdefault(row, []).append((a.label, start, stop))
                        done = stop
                        break
    return found


MATCHES = "array<struct<label: string, first: bigint, stop: bigint>>"


def scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text", phrases: Mapping[str, str] | None = None,
         templates: Mapping[str, list[str]] | None = None) -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score, matches) of each row.

    ``matches`` are the templates' accepted places; ``score`` is the share of
    the words that lie in one or in a base phrase.
    """
    base = [(WORD.findall(p.lower()), label) for p, label in (PHRASES if phrases is None else phrases).items()]
    automata = compile_templates(TEMPLATES if templates is None else templates)
    one = docs.select(F.col(id_col).alias("__id"), F.col(text).alias("__text"))
    kind = one.schema["__id"].dataType.simpleString()
    table = byte_table(digits=True)

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, 1):
                yield _report(part, table, base, automata)

    return one.mapInArrow(rows_of, f"`{id_col}` {kind}, n_words long, n_base long, first_word long, last_word long, "
                                   f"base_labels array<string>, labels array<string>, score double, matches {MATCHES}")


def _report(part: pa.RecordBatch, table: np.ndarray, base: list[tuple[list[str], str]],
            automata: list[Automaton]) -> pa.RecordBatch:
    words = _Words(part.column(1), table)
    n = np.diff(words.offsets)
    counts = np.zeros(part.num_rows, np.int64)
    first, last = np.full(part.num_rows, np.iinfo(np.int64).max), np.full(part.num_rows, -1)
    covered = np.zeros(len(words.codes) + 1, np.int64)  # +1 where a place starts, -1 behind it
    labels: list[set[str]] = [set() for _ in range(part.num_rows)]
    for phrase, label in base:
        places = words.places(phrase)
        rows = words.rows(places)
        np.add.at(counts, rows, 1)
        np.minimum.at(first, rows, places - words.offsets[rows])
        np.maximum.at(last, rows, places - words.offsets[rows])
        np.add.at(covered, places, 1)
        np.add.at(covered, places + len(phrase), -1)
        for row in np.unique(rows):
            labels[row].add(label)
    base_labels = [sorted(found) for found in labels]
    matches: list[list[dict]] = [[] for _ in range(part.num_rows)]
    for row, found in _accepted(words, automata).items():
        for label, start, stop in sorted(found, key=lambda m: (m[1], m[2], m[0])):
            labels[row].add(label)
            matches[row].append({"label": label, "first": start, "stop": stop})
            covered[words.offsets[row] + start] += 1
            covered[words.offsets[row] + stop] -= 1
    inside = np.concatenate([[0], np.cumsum(np.cumsum(covered[:-1]) > 0)])
    score = np.diff(inside[words.offsets]) / np.maximum(n, 1)
    return pa.RecordBatch.from_arrays([
        part.column(0), pa.array(n, pa.int64()), pa.array(counts), pa.array(first, pa.int64(), mask=counts == 0),
        pa.array(last, pa.int64(), mask=counts == 0), pa.array(base_labels, pa.list_(pa.string())),
        pa.array([sorted(found) for found in labels], pa.list_(pa.string())), pa.array(score, pa.float64()),
        pa.array(matches, pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("stop", pa.int64())])))],
        names=["id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "matches"])
