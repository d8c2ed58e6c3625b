"""License scans: license wordings as templates with markup, compiled into one token automaton.

A template is its mandatory wording with marked regions: ``<<beginOptional>>...<<endOptional>>`` may be left out (and may be
nested), ``<<var;words=2-8>>`` stands for any 2 to 8 words, and ``<<var;match=this file|the work>>`` for one of the given wordings.
A text is accepted where the words of a template stand one after the other, each mandatory word exactly, with any choice for the
regions. A template has to begin and end with a mandatory word, so every place has a definite first and last word.

All templates are compiled into one nondeterministic automaton over words. It is run as a deterministic one whose states are
made when a text first needs them: one look-up per word, whatever the number of templates. The states are forgotten when there
are more than ``MAX_STATES`` of them and made again, so memory is bounded and results do not change. Texts are
read in pieces of a megabyte; the last words of a piece are kept, as many as the longest template has.

The first word of a place with regions of open length is found by running the automaton backwards from its end: it is the latest
word from which the template can be accepted. Places may overlap, and all are counted.

A missing or empty text has no words and no places. Long texts are read whole; repeated rows are scanned one by one, ids may be
missing or repeated, extra columns are left out. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from ledgerloom.llm.common import pieces

MAX_STATES = 10_000
# A word keeps ASCII letters, digits and all bytes beyond ASCII; A-Z are lower-cased, and everything else separates words.
_WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

# The phrases that name a license, with their labels.
PHRASES = (("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license"))

# Wordings of well-known licenses, with the regions that may be left out or replaced.
TEMPLATES = (
    (
        "mit-text",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of <<var;match=this software|the software|this work>>
        <<beginOptional>>and associated documentation files<<endOptional>> <<beginOptional>>(the "<<var;words=1-3>>")<<endOptional>>, to deal
        in the <<var;words=1-3>> without restriction, including without limitation the rights to use, copy, modify, merge, publish,
        distribute, sublicense, and/or sell copies of the <<var;words=1-3>>, and to permit persons to whom the <<var;words=1-3>> is furnished
        to do so, subject to the following conditions: The above copyright notice and this permission notice
        <<beginOptional>>(including the next paragraph)<<endOptional>> shall be included in all copies or substantial portions of the software""",
    ),
    (
        "warranty-disclaimer",
        """the <<var;words=1-3>> is provided "as is", without warranty of any kind, express or implied, including but not limited to the warranties
        of merchantability, fitness for a particular purpose and <<var;match=noninfringement|non infringement>>. In no event shall
        <<var;words=1-20>> be liable for any claim, damages or other liability""",
    ),
    (
        "apache-notice",
        """Licensed under the Apache License, Version 2.0 <<beginOptional>>(the "License")<<endOptional>>; you may not use
        <<var;match=this file|this work|these files|this software>> except in compliance with the License. You may obtain a copy of the License at
        <<var;words=1-12>> Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
        "as is" basis, without warranties or conditions of any kind, either express or implied""",
    ),
    (
        "bsd-text",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions
        are met: <<var;words=0-1>> Redistributions of source code must retain the above copyright notice, this list of conditions and the following
        disclaimer. <<var;words=0-1>> Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
        following disclaimer in the documentation and/or other materials provided with the distribution""",
    ),
    (
        "bsd-no-endorsement",
        """Neither the <<var;match=name|names>> of <<var;words=1-20>> nor the names of <<var;match=its|their>> contributors may be used to endorse or
        promote products derived from this software without specific prior written permission""",
    ),
    (
        "isc-text",
        """Permission to use, copy, modify, <<var;match=and|and/or>> distribute this software for any purpose with or without fee is hereby granted,
        provided that the above copyright notice and this permission notice appear in all copies""",
    ),
    (
        "gpl-notice",
        """This <<var;match=program|software|library|work>> is free software<<beginOptional>>:<<endOptional>> you can redistribute it and/or modify it
        under the terms of the GNU <<var;match=|Lesser|Affero|Library>> General Public License as published by the Free Software Foundation; either
        version <<var;words=1-2>> of the License, or <<beginOptional>>(at your option)<<endOptional>> any later version""",
    ),
    ("gpl-reference", "licensed under <<beginOptional>>the terms of<<endOptional>> the GNU <<var;match=|Lesser|Affero>> General Public License, version"),
    ("apache-reference", "Licensed under <<beginOptional>>the terms of<<endOptional>> the Apache License, Version 2.0"),
    ("mit-reference", "under <<beginOptional>>the terms of<<endOptional>> the <<var;match=|Expat>> MIT License"),
    ("cc-reference", "licensed under <<beginOptional>>the terms of<<endOptional>> <<beginOptional>>the<<endOptional>> <<var;match=CC|Creative Commons>> BY"),
)

_MARK = re.compile(r"<<(beginOptional|endOptional|var;(?:words=(\d+)-(\d+)|match=([^<>]*)))>>")


def words_of(data: bytes) -> list[bytes]:
    return data.translate(_WORD_BYTES).split()


def parsed(markup: str) -> list[tuple]:
    """Items of a template: ("word", w), ("any", least, most), ("one of", [items, ...]) and ("optional", items)."""
    top: list[tuple] = []
    open_lists = [top]
    at = 0
    for mark in [*_MARK.finditer(markup), None]:
        plain = markup[at : mark.start()] if mark else markup[at:]
        if "<<" in plain or ">>" in plain:
            raise ValueError(f"unknown mark in {plain!r}")
        open_lists[-1].extend(("word", w) for w in words_of(plain.encode()))
        if mark is None:
            break
        at = mark.end()
        if mark[1] == "beginOptional":
            open_lists.append([])
        elif mark[1] == "endOptional":
            if len(open_lists) == 1:
                raise ValueError("endOptional without beginOptional")
            items = open_lists.pop()
            open_lists[-1].append(("optional", items))
        elif mark[2] is not None:
            if int(mark[2]) > int(mark[3]):
                raise ValueError(f"least above most in {mark[0]!r}")
            open_lists[-1].append(("any", int(mark[2]), int(mark[3])))
        else:
            choices = [[("word", w) for w in words_of(c.encode())] for c in mark[4].split("|")]
            open_lists[-1].append(("one of", choices))
    if len(open_lists) > 1:
        raise ValueError("beginOptional without endOptional")
    if not top or top[0][0] != "word" or top[-1][0] != "word":
        raise ValueError("a template begins and ends with a mandatory word")
    return top


def longest(items: list[tuple]) -> int:
    """The most words that the items can take."""
    size = {"word": lambda i: 1, "any": lambda i: i[2], "optional": lambda i: longest(i[1]), "one of": lambda i: max(map(longest, i[1]))}
    return sum(size[i[0]](i) for i in items)


class Automaton:
    """The templates as one automaton: steps by word (None: any word), free steps, and the template each final state accepts."""

    def __init__(self, templates: tuple[tuple[str, str], ...]) -> None:
        self.labels = [label for label, _ in templates]
        self.steps: list[list[tuple[bytes | None, int]]] = [[]]
        self.free: list[list[int]] = [[]]
        self.accepts: dict[int, int] = {}
        self.longest = 0
        for number, (_, markup) in enumerate(templates):
            items = parsed(markup)
            self.longest = max(self.longest, longest(items))
            self.accepts[self._wire(items, 0)] = number
        self.known = {w: w for state in self.steps for w, _ in state if w is not None}
        self.back: list[list[tuple[bytes | None, int]]] = [[] for _ in self.steps]
        self.back_free: list[list[int]] = [[] for _ in self.steps]
        for state, (steps, free) in enumerate(zip(self.steps, self.free)):
            for w, to in steps:
                self.back[to].append((w, state))
            for to in free:
                self.back_free[to].append(state)

    def _state(self) -> int:
        self.steps.append([])
        self.free.append([])
        return len(self.steps) - 1

    def _wire(self, items: list[tuple], state: int) -> int:
        """Adds the items behind a state and gives the state after them."""
        for kind, *given in items:
            if kind == "word":
                to = self._state()
                self.steps[state].append((given[0], to))
            elif kind == "any":
                to, least, most = self._state(), *given
                for taken in range(most + 1):
                    if taken >= least:
                        self.free[state].append(to)
                    if taken < most:
                        after = self._state()
                        self.steps[state].append((None, after))
                        state = after
            elif kind == "optional":
                to = self._wire(given[0], state)
                self.free[state].append(to)
            else:
                to = self._state()
                for choice in given[0]:
                    self.free[self._wire(choice, state)].append(to)
            state = to
        return state

    @staticmethod
    def _closed(states: set[int], free: list[list[int]]) -> frozenset[int]:
        todo, seen = list(states), set(states)
        while todo:
            for to in free[todo.pop()]:
                if to not in seen:
                    seen.add(to)
                    todo.append(to)
        return frozenset(seen)

    def after(self, states: frozenset[int], word: bytes | None) -> frozenset[int]:
        """The states after one more word (None: a word of no template); a new place may begin at every word."""
        reached = {to for s in states for w, to in self.steps[s] if w is None or w == word}
        return self._closed(reached | {0}, self.free)

    def first_word(self, final: int, words: list[bytes], last: int) -> int:
        """The latest first word of a place that ends at ``last``."""
        states = self._closed({final}, self.back_free)
        for at in range(last, -1, -1):
            reached = {s for state in states for w, s in self.back[state] if w is None or w == words[at]}
            states = self._closed(reached, self.back_free)
            if 0 in states:
                return at
        raise AssertionError("an accepted place has a first word")


class Scanner:
    """Runs an automaton over texts; keeps the deterministic states met so far."""

    def __init__(self, automaton: Automaton) -> None:
        self.automaton = automaton
        self._forget(automaton._closed({0}, automaton.free))

    def _forget(self, states: frozenset[int]) -> int:
        """Starts over with the start state, at number 0, and the given states."""
        start = self.automaton._closed({0}, self.automaton.free)
        self.numbers, self.sets, self.next, self.finals = {}, [], [], []
        self._number(start)
        return self._number(states)

    def _number(self, states: frozenset[int]) -> int:
        if states not in self.numbers:
            self.numbers[states] = len(self.sets)
            self.sets.append(states)
            self.next.append({})
            self.finals.append(tuple(sorted(s for s in states if s in self.automaton.accepts)))
        return self.numbers[states]

    def _step(self, state: int, word: bytes | None) -> int:
        reached = self.automaton.after(self.sets[state], word)
        if len(self.sets) >= MAX_STATES and reached not in self.numbers:
            return self._forget(reached)
        self.next[state][word] = number = self._number(reached)
        return number

    def places(self, data: bytes) -> tuple[int, list[tuple[int, int, int]]]:
        """Number of words, and (template, first word, word after the last) of every place, in order of their ends."""
        known, found, state, total, kept = self.automaton.known.get, [], 0, 0, []
        for piece in pieces(data):
            words = words_of(piece)
            for at, w in enumerate(words):
                word = known(w)
                if word is None and state == 0:
                    continue
                to = self.next[state].get(word)
                state = self._step(state, word) if to is None else to
                for final in self.finals[state]:
                    recent = kept + words[max(0, at + 1 - self.automaton.longest) : at + 1]
                    first = self.automaton.first_word(final, recent, len(recent) - 1)
                    end = total + at + 1
                    found.append((self.automaton.accepts[final], end - len(recent) + first, end))
            total += len(words)
            kept = (kept + words)[-self.automaton.longest :]
        return total, found


def scan(
    docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, phrases: tuple[tuple[str, str], ...] = PHRASES,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Per row: ``id_col``, n_words, the places of phrases (n_base, first_word, last_word, base_labels), the labels of phrases and
    templates, a score (0 nothing, 0.5 a license is only named, 1 a template is accepted) and all places as ``spans``."""
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    automaton = Automaton((*phrases, *templates))
    span = StructType([StructField("label", StringType()), StructField("first", LongType()), StructField("end", LongType())])
    columns = [
        ("n_words", LongType(), pa.int64()), ("n_base", LongType(), pa.int64()), ("first_word", LongType(), pa.int64()),
        ("last_word", LongType(), pa.int64()), ("base_labels", StringType(), pa.string()), ("labels", StringType(), pa.string()),
        ("score", DoubleType(), pa.float64()),
        ("spans", ArrayType(span), pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("end", pa.int64())]))),
    ]
    schema = StructType([StructField(id_col, rows.schema["id"].dataType), *(StructField(n, kind) for n, kind, _ in columns)])
    n_phrases = len(phrases)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(automaton)
        for batch in batches:
            out: list[list] = [[] for _ in columns]
            for text in batch.column(1):
                total, found = scanner.places(text.as_buffer().to_pybytes() if text.is_valid else b"")
                base = [f for f in found if f[0] < n_phrases]
                label = automaton.labels.__getitem__
                row = (
                    total, len(base), min((f[1] for f in base), default=None), max((f[1] for f in base), default=None),
                    ",".join(sorted({label(f[0]) for f in base})), ",".join(sorted({label(f[0]) for f in found})),
                    0.0 if not found else 0.5 if len(base) == len(found) else 1.0,
                    [{"label": label(t), "first": a, "end": b} for t, a, b in found],
                )
                for values, value in zip(out, row):
                    values.append(value)
            arrays = [pa.array(values, kind) for values, (_, _, kind) in zip(out, columns)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=[id_col, *(n for n, _, _ in columns)])

    return rows.mapInArrow(read, schema)


def as_pattern(markup: str) -> str:
    """The template as a regular expression over words that are each followed by a blank, for checks in SQL."""

    def of(items: list[tuple]) -> str:
        return "".join(one(i) for i in items)

    def one(item: tuple) -> str:
        kind, *given = item
        if kind == "word":
            return f"{given[0].decode()} "
        if kind == "any":
            return f"(?:[^ ]+ ){{{given[0]},{given[1]}}}"
        if kind == "optional":
            return f"(?:{of(given[0])})?"
        return "(?:" + "|".join(of(c) for c in given[0]) + ")"

    return " " + of(parsed(markup))
