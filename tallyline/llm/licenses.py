"""License scan: templates with optional and replaceable regions, compiled into one automaton over words.

A template is wording with the mark-up of the public license lists: `<<beginOptional>>` … `<<endOptional>>` may be left out,
`<<var;words="2-30">>` stands for 2 to 30 words of any kind. All templates become one nondeterministic automaton over their own
words and one letter for every other word. It is made deterministic as texts ask for it, so each start costs a step a word until no
template can go on. A template accepts where its whole mandatory wording stands, word for word.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.text import NOT_LETTERS, byte_slices

SLICE_BYTES = 4 << 20
#: Deterministic states kept by a Python worker; beyond that it starts with none. No result depends on it.
KEPT_STATES = 100_000
MATCHES = "array<struct<label: string, base: boolean, start: bigint, stop: bigint>>"

# ---- fixed values: phrases and license wording with mark-up --------------------------------

PHRASES = (("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license"))

_AS_IS = ('THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
          "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.")
_BSD = ('<<beginOptional>>THIS SOFTWARE IS PROVIDED BY <<var;words="1-20">> "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, '
        "BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.<<endOptional>>")
_SOURCE = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
           "conditions are met: <<beginOptional>>1.<<endOptional>> Redistributions of source code must retain the above copyright notice, "
           "this list of conditions and the following disclaimer. <<beginOptional>>2.<<endOptional>> Redistributions in binary form must "
           "reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
           "materials provided with the distribution.")
TEMPLATES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
            'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
            "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software "
            "is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice "
            "<<beginOptional>>(including the next paragraph)<<endOptional>> shall be included in all copies or substantial portions of the "
            f"Software. {_AS_IS}"),
    ("mit", "Released under the <<beginOptional>>terms of the<<endOptional>> MIT License"),
    ("mit", "<<beginOptional>>This <<var;words=\"1-3\">> is<<endOptional>> licensed under the <<beginOptional>>terms of the<<endOptional>> MIT License"),
    ("mit", "SPDX License Identifier MIT"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
            "that the above copyright notice and this permission notice appear in all copies"),
    ("bsd-2-clause", f"{_SOURCE} {_BSD}"),
    ("bsd-3-clause", f'{_SOURCE} <<beginOptional>>3.<<endOptional>> Neither the name of <<var;words="1-20">> nor the names of its contributors '
                     "may be used to endorse or promote products derived from this software without specific prior written permission. "
                     f"{_BSD}"),
    ("apache-2.0", "<<beginOptional>>This <<var;words=\"1-3\">> is<<endOptional>> licensed under the Apache License, Version 2.0 <<beginOptional>>(the "
                   '"License"); you may not use this file except in compliance with the License. <<beginOptional>>You may obtain a copy of the '
                   'License at <<var;words="1-12">><<endOptional>> Unless required by applicable law or agreed to in writing, software distributed '
                   'under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or '
                   "implied.<<endOptional>>"),
    ("apache-2.0", "SPDX License Identifier Apache 2.0"),
    ("gpl-3.0", "<<beginOptional>>This <<var;words=\"1-3\">> is<<endOptional>> licensed under the <<beginOptional>>terms of the<<endOptional>> GNU General "
                "Public License, <<beginOptional>>as published by the Free Software Foundation,<<endOptional>> version 3 "
                "<<beginOptional>>or later<<endOptional>>"),
    ("gpl-3.0", "<<beginOptional>>you can<<endOptional>> redistribute it and/or modify it under the terms of the GNU General Public License as "
                "published by the Free Software Foundation, either version 3 of the License, or <<beginOptional>>(at your option)<<endOptional>> any "
                "later version"),
    ("gpl-2.0", "<<beginOptional>>you can<<endOptional>> redistribute it and/or modify it under the terms of the GNU General Public License as "
                "published by the Free Software Foundation, either version 2 of the License, or <<beginOptional>>(at your option)<<endOptional>> any "
                "later version"),
    ("cc-by-4.0", "<<beginOptional>>This <<var;words=\"1-3\">> is<<endOptional>> licensed under <<beginOptional>>the<<endOptional>> CC BY 4.0"),
    ("cc-by-sa-4.0", "<<beginOptional>>This <<var;words=\"1-3\">> is<<endOptional>> licensed under <<beginOptional>>the<<endOptional>> CC BY-SA 4.0"),
    ("cc-by-nc-4.0", "<<beginOptional>>This <<var;words=\"1-3\">> is<<endOptional>> licensed under <<beginOptional>>the<<endOptional>> CC BY-NC 4.0"),
    ("cc-by-nc-4.0", "<<beginOptional>>This <<var;words=\"1-3\">> is<<endOptional>> licensed under a Creative Commons Attribution NonCommercial 4.0 "
                     "International License"),
    ("cc0-1.0", "To the extent possible under law, <<var;words=\"1-20\">> waived all copyright and related or neighboring rights to"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)

# ----------------------------------------------------------------------------------------

_CLASSES = bytes(32 if b in frozenset(NOT_LETTERS.tolist()) - frozenset(range(65, 91)) else b + 32 if 65 <= b < 91 else b
                 for b in range(256))
_MARK = re.compile(r'<<(beginOptional|endOptional|var;[^>]*?words="([0-9]+)-([0-9]+)"[^>]*)>>')


def words_of(text: bytes) -> list[bytes]:
    """The words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of UTF-8 text, A-Z lower-cased."""
    return text.translate(_CLASSES).split()


@dataclass(frozen=True)
class Region:
    parts: tuple


@dataclass(frozen=True)
class Gap:
    least: int
    most: int


def parse(template: str) -> tuple:
    """The parts of a template: words (bytes), `Gap` and nested `Region`."""
    levels: list[list] = [[]]
    at = 0
    for mark in _MARK.finditer(template):
        levels[-1] += words_of(template[at:mark.start()].encode())
        at = mark.end()
        if mark[1] == "beginOptional":
            levels.append([])
        elif mark[1] == "endOptional":
            if len(levels) == 1:
                raise ValueError("endOptional without beginOptional")
            inner = levels.pop()
            levels[-1].append(Region(tuple(inner)))
        else:
            if int(mark[2]) > int(mark[3]):
                raise ValueError(f"no such number of words: {mark[0]}")
            levels[-1].append(Gap(int(mark[2]), int(mark[3])))
    levels[-1] += words_of(template[at:].encode())
    if len(levels) > 1:
        raise ValueError("beginOptional without endOptional")
    return tuple(levels[0])


class Automaton:
    """All templates in one automaton. Letter 0 is any word that no template names."""

    def __init__(self, templates: tuple[tuple, ...]):
        self.vocabulary: dict[bytes, int] = {}
        self.by_word: list[dict[int, int]] = []
        self.by_any: list[int] = []
        self.free: list[list[int]] = []
        self.accepts: dict[int, int] = {}
        self.root = self._state()
        for number, parts in enumerate(templates):
            first = self._state()
            self.free[self.root].append(first)
            last = self._compile(parts, first)
            if last in self._closure({first}):
                raise ValueError("a template needs mandatory wording")
            self.accepts[last] = number
        self._forget()
        self.starts = np.zeros(len(self.vocabulary) + 1, bool)
        for state in self._closure({self.root}):
            self.starts[list(self.by_word[state])] = True
            if self.by_any[state] >= 0:
                self.starts[:] = True

    def _state(self) -> int:
        self.by_word.append({})
        self.by_any.append(-1)
        self.free.append([])
        return len(self.free) - 1

    def _compile(self, parts: tuple, at: int) -> int:
        for part in parts:
            if isinstance(part, Region):
                end = self._compile(part.parts, at)
                after = self._state()
                self.free[at].append(after)
                self.free[end].append(after)
            elif isinstance(part, Gap):
                after = self._state()
                for used in range(part.most + 1):
                    if used >= part.least:
                        self.free[at].append(after)
                    if used < part.most:
                        self.by_any[at] = step = self._state()
                        at = step
            else:
                letter = self.vocabulary.setdefault(part, len(self.vocabulary) + 1)
                after = self._state()
                self.by_word[at][letter] = after
            at = after
        return at

    def _closure(self, states: set[int]) -> frozenset[int]:
        todo, seen = list(states), set(states)
        while todo:
            for state in self.free[todo.pop()]:
                if state not in seen:
                    seen.add(state)
                    todo.append(state)
        return frozenset(seen)

    def _forget(self) -> None:
        self.number: dict[frozenset[int], int] = {}
        self.members: list[frozenset[int]] = []
        self.moves: list[dict[int, int]] = []
        self.found: list[tuple[int, ...]] = []
        self._known(self._closure({self.root}))

    def _known(self, members: frozenset[int]) -> int:
        if members not in self.number:
            self.number[members] = len(self.members)
            self.members.append(members)
            self.moves.append({})
            self.found.append(tuple(sorted({self.accepts[s] for s in members if s in self.accepts})))
        return self.number[members]

    def _move(self, state: int, letter: int) -> int:
        """The deterministic step; -1 where no template can go on."""
        after = set()
        for s in self.members[state]:
            if letter in self.by_word[s]:
                after.add(self.by_word[s][letter])
            if self.by_any[s] >= 0:
                after.add(self.by_any[s])
        to = self.moves[state][letter] = self._known(self._closure(after)) if after else -1
        return to

    def longest(self, letters: list[int], start: int) -> dict[int, int]:
        """Each template that accepts from `start` on, with the end of its longest match."""
        if len(self.members) > KEPT_STATES:
            self._forget()
        out: dict[int, int] = {}
        state, at, n, moves, found = 0, start, len(letters), self.moves, self.found
        while at < n:
            letter = letters[at]
            to = moves[state].get(letter)
            if to is None:
                to = self._move(state, letter)
            if to < 0:
                break
            state = to
            at += 1
            for template in found[state]:
                out[template] = at
        return out


class Scanner:
    """Phrases, found in every place, and templates, found in their leftmost longest places that do not overlap."""

    def __init__(self, templates: tuple[tuple[str, str], ...], phrases: tuple[tuple[str, str], ...]):
        self.labels = [label for label, _ in (*phrases, *templates)]
        self.n_phrases = len(phrases)
        self.automaton = Automaton(tuple(parse(text) for _, text in (*phrases, *templates)))

    def scan(self, text: bytes) -> tuple[int, list[tuple[str, bool, int, int]]]:
        """The number of words, and (label, base, start, stop) of all matches by start, stop, base and label."""
        words = words_of(text)
        letters = np.fromiter(map(self.automaton.vocabulary.get, words, repeat(0)), np.int64, len(words))
        starts = np.flatnonzero(self.automaton.starts[letters]).tolist()
        if not starts:
            return len(words), []
        letters, ends, out = letters.tolist(), {}, set()
        for start in starts:
            for template, stop in self.automaton.longest(letters, start).items():
                base = template < self.n_phrases
                if base or start >= ends.get(template, 0):
                    ends[template] = stop
                    out.add((self.labels[template], base, start, stop))
        return len(words), sorted(out, key=lambda m: (m[2], m[3], not m[1], m[0]))


def scan_licenses(texts: DataFrame, key: str = "doc_id", text: str = "text",
                  templates: tuple[tuple[str, str], ...] = TEMPLATES,
                  phrases: tuple[tuple[str, str], ...] = PHRASES) -> DataFrame:
    """`key`, n_words and matches of every row, in one pass without a shuffle.

    Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of the whole text with A-Z lower-cased, numbered from 0. matches: array of
    (label, base, start, stop), stop exclusive, by start and stop. `phrases` are (label, words): every place where the words stand
    one after another is a base match. `templates` are (label, wording with mark-up): of each template the leftmost and there longest
    matches that do not overlap; places that two templates of one label accept alike are one match. A null or empty text has no
    words and no matches. A null or repeated key is carried through, one result per input row; other columns are left out.
    """
    Scanner(templates, phrases)  # A wrong template fails here and not in a task.

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, phrases)
        kind = pa.list_(pa.struct([("label", pa.string()), ("base", pa.bool_()), ("start", pa.int64()), ("stop", pa.int64())]))
        for batch in batches:
            for part in byte_slices(batch, "text", SLICE_BYTES):
                scanned = [scanner.scan(body or b"") for body in part.column("text").cast(pa.large_binary()).to_pylist()]
                matches = [[dict(zip(("label", "base", "start", "stop"), m, strict=True)) for m in found] for _, found in scanned]
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), pa.array([n for n, _ in scanned], pa.int64()), pa.array(matches, kind)],
                    names=["key", "n_words", "matches"])

    kind_of_key = texts.schema[key].dataType.simpleString()
    return (texts.select(F.col(key).alias("key"), F.col(text).alias("text"))
            .mapInArrow(run, f"key {kind_of_key}, n_words long, matches {MATCHES}")
            .select(F.col("key").alias(key), "n_words", "matches"))
