"""Licence scans: matching statistics against a generalised suffix automaton of licence words.

The words of all licence texts and phrases form one suffix automaton. A document is streamed
through it word by word; at every word the automaton knows the longest run of words ending
there that occurs in some licence text (the matching statistics). Runs that cannot be made
longer are long matches; those of one licence are chained in the order of both the document
and the licence, and a chain that covers enough of a licence is a span of it. A phrase stands
at a word if the current run ends with it, which the suffix links of the automaton tell.

The automaton is small and bounded by the licence texts given; the documents are neither
shuffled nor stored, and a text is read in pieces, so its length does not matter.

Words are runs of letters, digits and non-ASCII characters; A-Z count as a-z.

Defined cases: a null or empty text has no words, no labels and score 0; rows that repeat a
doc_id, or have none, are rows of their own; an empty table gives no rows; of the documents
only the asked-for columns and the text are read, so other names do not matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from usagelens.llm.common import small_batches

# Phrases and their labels: fixed values of the base rule.
PHRASES = (
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
)
# Phrases that name one version or variant; they count whole and add a label of their own.
VARIANTS = (
    ("agpl-3.0", "gnu affero general public license version 3"),
    ("apache-2.0", "apache license version 2 0"),
    ("bsd-2-clause", "bsd 2 clause license"),
    ("bsd-3-clause", "bsd 3 clause license"),
    ("cc-by-4.0", "cc by 4 0"),
    ("cc-by-nc-4.0", "cc by nc 4 0"),
    ("cc-by-nd-4.0", "cc by nd 4 0"),
    ("cc-by-sa-4.0", "cc by sa 4 0"),
    ("cc0-1.0", "cc0 1 0"),
    ("gpl-2.0", "gnu general public license version 2"),
    ("gpl-3.0", "gnu general public license version 3"),
    ("lgpl-3.0", "gnu lesser general public license version 3"),
    ("mpl-2.0", "mozilla public license version 2 0"),
)
# Published licence texts and notices: fixed values.
TEMPLATES = (
    (
        "agpl-notice",
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU Affero General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version. This program is distributed "
        "in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
        "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General "
        "Public License for more details.",
    ),
    (
        "apache-2.0-notice",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License.",
    ),
    (
        "bsd-text",
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met: Redistributions of source code must retain the "
        "above copyright notice, this list of conditions and the following disclaimer. Redistributions "
        "in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the "
        "distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND "
        "ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF "
        "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
    ),
    (
        "cc-by-notice",
        "This work is licensed under a Creative Commons Attribution 4.0 International License. To view "
        "a copy of this license, visit http://creativecommons.org/licenses/by/4.0/ or send a letter to "
        "Creative Commons",
    ),
    (
        "gpl-notice",
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, either version 3 "
        "of the License, or (at your option) any later version. This program is distributed in the "
        "hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for "
        "more details.",
    ),
    (
        "isc-text",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this permission "
        "notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL "
        "WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY "
        "AND FITNESS.",
    ),
    (
        "mit-text",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files (the \"Software\"), to deal in the Software without "
        "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of "
        "the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR "
        "IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
        "PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    ),
    (
        "mpl-2.0-notice",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy "
        "of the MPL was not distributed with this file, You can obtain one at "
        "https://mozilla.org/MPL/2.0/.",
    ),
    (
        "unlicense-text",
        "This is free and unencumbered software released into the public domain. Anyone is free to "
        "copy, modify, publish, use, compile, sell, or distribute this software, either in source code "
        "form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
)
# Words of a long match at least, the covered share that makes a span, words between two
# matches of a chain at most, and bytes of a text cut into words at once.
LONG, COVERED, GAP, PIECE = 4, 0.6, 40, 1 << 20
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BETWEEN = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]")


def words_of(text: str) -> Iterator[list[bytes]]:
    """The words of a text, in lists, cut only between words."""
    data, at = text.encode("utf-8", "surrogatepass").lower(), 0
    while at < len(data):
        cut = BETWEEN.search(data, at + PIECE)
        to = cut.start() if cut else len(data)
        yield WORD.findall(data, at, to)
        at = to


def all_words(text: str) -> list[bytes]:
    return [w for piece in words_of(text) for w in piece]


class Match(NamedTuple):
    """Words ``end - length + 1`` to ``end`` of a document, in a state of the automaton."""

    end: int
    length: int
    state: int


class Span(NamedTuple):
    label: str
    first_word: int
    last_word: int
    covered: int
    coverage: float


class Automaton:
    """Generalised suffix automaton: the states of all runs of words of the given texts.

    ``length[v]`` is the longest run of state v, ``link[v]`` the state of its longest suffix
    that occurs in more places. ``places[v]`` holds (text, last word) of all places of a state
    with runs of ``LONG`` words or more, ``phrases[v]`` (words, number) of the whole phrases
    that a run in v can end with.
    """

    def __init__(self, texts: Iterable[list[bytes]], phrases: Iterable[list[bytes]]) -> None:
        texts, phrases = list(texts), list(phrases)
        vocabulary = sorted({w for t in [*texts, *phrases] for w in t})
        self.word = {w: k for k, w in enumerate(vocabulary)}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: dict[int, set] = {}
        for number, text in enumerate(texts):
            state = 0
            for at, w in enumerate(text):
                state = self.extended(state, self.word[w])
                ends.setdefault(state, set()).add((number, at))
        last = []
        for phrase in phrases:
            state = 0
            for w in phrase:
                state = self.extended(state, self.word[w])
            last.append(state)
        order = sorted(range(len(self.link)), key=lambda v: self.length[v])
        for v in reversed(order):
            if self.link[v] > 0:
                ends.setdefault(self.link[v], set()).update(ends.get(v, ()))
        self.places = [sorted(ends.get(v, ())) if self.length[v] >= LONG else [] for v in range(len(self.link))]
        own: dict[int, list] = {}
        for number, v in enumerate(last):
            own.setdefault(v, []).append((len(phrases[number]), number))
        self.phrases: list[tuple] = [()] * len(self.link)
        for v in order[1:]:
            self.phrases[v] = (*self.phrases[self.link[v]], *sorted(own.get(v, ())))

    def added(self, length: int, link: int, transitions: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(transitions)
        return len(self.link) - 1

    def split(self, before: int, state: int, word: int) -> int:
        """The runs of ``state`` up to one word longer than ``before`` as a state of their own."""
        copy = self.added(self.length[before] + 1, self.link[state], dict(self.next[state]))
        self.link[state] = copy
        while before >= 0 and self.next[before].get(word) == state:
            self.next[before][word] = copy
            before = self.link[before]
        return copy

    def extended(self, last: int, word: int) -> int:
        """The state of the run of ``last`` with one more word, made if there is none."""
        there = self.next[last].get(word)
        if there is not None:
            exact = self.length[there] == self.length[last] + 1
            return there if exact else self.split(last, there, word)
        new, at = self.added(self.length[last] + 1, 0, {}), last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = new
            at = self.link[at]
        if at >= 0:
            there = self.next[at][word]
            exact = self.length[there] == self.length[at] + 1
            self.link[new] = there if exact else self.split(at, there, word)
        return new

    def stream(self, pieces: Iterable[list[bytes]]) -> Iterator[tuple[int, int, int]]:
        """(word, longest run that ends there, its state) wherever that run is not empty, and
        (word, 0, 0) where one ends; the last is (number of words, 0, 0)."""
        word, step, link, length = self.word.get, self.next, self.link, self.length
        state = run = at = 0
        for piece in pieces:
            for at, name in enumerate(piece, at):  # noqa: B020
                w = word(name)
                if w is None:
                    if run:
                        state = run = 0
                        yield at, 0, 0
                    continue
                while state and w not in step[state]:
                    state = link[state]
                    run = length[state]
                if w in step[state]:
                    state, run = step[state][w], run + 1
                    yield at, run, state
                elif run:
                    run = 0
                    yield at, 0, 0
            at += bool(piece)
        yield at, 0, 0


def long_matches(stream: Iterable[tuple[int, int, int]]) -> Iterator[Match]:
    """Runs that no next word makes longer, of ``LONG`` words or more, from the statistics."""
    before = Match(-1, 0, 0)
    for at, run, state in stream:
        if before.length >= LONG and run <= before.length:
            yield before
        before = Match(at, run, state)


class Chains:
    """The best chain of one licence's matches, as they come in the order of the document.

    A chain takes matches whose places in the licence rise; what a match shares with words
    covered before is left off. The best chain before a place is a prefix maximum, kept in a
    binary indexed tree, so a match costs the logarithm of the licence's words. A gap of more
    than ``GAP`` words closes the chain.
    """

    def __init__(self, label: str, words: int) -> None:
        self.label, self.words, self.spans = label, words, []
        self.open()

    def open(self) -> None:
        self.tree = [(0, 0)] * (self.words + 1)
        self.best = (0, 0, 0)
        self.to = -1

    def add(self, match: Match, ends: list[int]) -> None:
        first = match.end - match.length + 1
        if self.best[0] and first - self.to > GAP:
            self.close()
        length = match.end - max(first, self.to + 1) + 1
        if length <= 0:
            return
        first = match.end - length + 1
        found = []
        for end in ends:
            covered, since = 0, first
            at = end - length + 1
            while at > 0:
                if self.tree[at][0] > covered:
                    covered, since = self.tree[at][0], -self.tree[at][1]
                at &= at - 1
            found.append((covered + length, since, end))
        for covered, since, end in found:
            at = end + 1
            while at <= self.words:
                # Of equal chains the one that starts first.
                self.tree[at] = max(self.tree[at], (covered, -since))
                at += at & -at
            if covered > self.best[0]:
                self.best = (covered, since, match.end)
        self.to = match.end

    def close(self) -> None:
        covered, first, last = self.best
        if covered:
            self.spans.append(Span(self.label, first, last, covered, covered / self.words))
        self.open()


class Scanner:
    """The automaton of some licences and what one document says about them."""

    def __init__(self, phrases=PHRASES, variants=VARIANTS, templates=TEMPLATES) -> None:
        self.labels = [label for label, _ in [*phrases, *variants]]
        self.base = len(phrases)
        self.templates = [(label, all_words(text)) for label, text in templates]
        self.automaton = Automaton(
            [words for _, words in self.templates],
            [all_words(text) for _, text in [*phrases, *variants]],
        )

    def scan(self, text: str) -> dict:
        starts: list[int] = []
        named: set[int] = set()
        size = 0

        def watched() -> Iterator[tuple[int, int, int]]:
            nonlocal size
            for at, run, state in self.automaton.stream(words_of(text)):
                for words, number in self.automaton.phrases[state]:
                    if words <= run:
                        named.add(number)
                        if number < self.base:
                            starts.append(at - words + 1)
                yield at, run, state
                size = at

        chains: dict[int, Chains] = {}
        for match in long_matches(watched()):
            by_text: dict[int, list[int]] = {}
            for number, end in self.automaton.places[match.state]:
                by_text.setdefault(number, []).append(end)
            for number, ends in by_text.items():
                label, words = self.templates[number]
                chains.setdefault(number, Chains(label, len(words))).add(match, ends)
        for chain in chains.values():
            chain.close()
        spans = sorted(s for c in chains.values() for s in c.spans if s.coverage >= COVERED)
        best = max((s.coverage for c in chains.values() for s in c.spans), default=0.0)
        labels = {self.labels[number] for number in named}
        return {
            "n_words": size,
            "n_base": len(starts),
            "first_word": min(starts, default=None),
            "last_word": max(starts, default=None),
            "base_labels": sorted({self.labels[number] for number in named if number < self.base}),
            "labels": sorted(labels | {s.label for s in spans}),
            "spans": spans,
            "score": 1 - (0.5 if named else 1.0) * (1 - best),
        }


RESULT = (
    "n_words long, n_base long, first_word long, last_word long, base_labels array<string>, "
    "labels array<string>, spans array<struct<label string, first_word long, last_word long, "
    "covered long, coverage double>>, score double"
)


def scan(
    documents: DataFrame, columns: list[str], phrases=PHRASES, variants=VARIANTS, templates=TEMPLATES
) -> DataFrame:
    """``columns`` and, for every document, its words, the places of the phrases (number, first
    and last start), labels of phrases, all labels, the licence spans, and a score.

    The score is the covered share c of the licence covered best; where a phrase stands it is
    (1 + c) / 2.
    """
    scanner = Scanner(phrases, variants, templates)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [scanner.scan(t) if t else scanner.scan("") for t in batch.pop("text of the row")]
            for name in ("n_words", "n_base", "base_labels", "labels", "score"):
                batch[name] = [row[name] for row in found]
            for name in ("first_word", "last_word"):
                batch[name] = pd.array([row[name] for row in found], "Int64")
            batch["spans"] = [[s._asdict() for s in row["spans"]] for row in found]
            yield batch[[f.name for f in kind.fields]]

    source = documents.select(*columns, F.col("text").alias("text of the row"))
    kind = StructType(
        [f for f in source.schema.fields if f.name != "text of the row"]
        + StructType.fromDDL(RESULT).fields
    )
    with small_batches(documents.sparkSession):
        return source.mapInPandas(run, kind)
