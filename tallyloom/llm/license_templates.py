"""License scans: templates with marked regions become token automata that read the words of a text.

A template is wording with markup:

    <<beginOptional>> ... <<endOptional>>    may be left out as a whole, and may hold other regions
    <<var; match="version 2 | v2">>          is replaced by one of the listed wordings
    <<var; match=".{1,40}">>                 is replaced by 1 to 40 words of any kind

All other words are mandatory and have to stand in the text exactly, in order, with nothing between them. Case (A-Z), punctuation
and white space do not count, since both sides are read as words. All templates are compiled into one automaton whose edges are
words; its sets of states are found while texts are read, so that each word of a match costs one look-up. The automaton has no
loops: a match has a longest length, so a long text is read in pieces that overlap by it, and memory does not grow with a text.

The phrases of `PHRASES` are counted at every place. `TEMPLATES` adds labels of its own. The score is m / (m + 4) for the m
mandatory words of the strongest wording accepted, a phrase included.

Null and empty texts have no words, no labels and score 0. Repeated rows give a row each; a null doc_id stays null. Labels are
sets, so wordings that overlap or repeat count once. Columns other than id and text are not read; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame

from tallyloom.llm import common

# Bytes of a text that are turned into words at once.
PIECE = 1 << 20
# Sets of automaton states remembered in a worker; beyond that they are forgotten and found again.
REMEMBERED = 20_000
_HALF = 4.0
_MARKUP = re.compile(r"<<(.*?)>>", re.S)
_ANY = re.compile(r"\.\{(\d+),(\d+)\}")
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
# No capital is a gap: texts are cut into pieces before they are lower-cased.
_GAP = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")

# Phrases whose places are counted, and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

_GRANT = (
    '<<var; match="licensed | released | distributed | published | available | provided | covered">> under '
    "<<beginOptional>>the <<beginOptional>>terms <<beginOptional>>and conditions<<endOptional>> of the<<endOptional>><<endOptional>> "
)
_SOURCE = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met: <<var; match=\".{0,1}\">> Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. <<var; match=\".{0,1}\">> Redistributions in binary form must reproduce the above copyright "
    "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution. "
)
_NO_WARRANTY = (
    "This software is provided by <<var; match=\".{1,12}\">> \"as is\" and any express or implied warranties, including, but not limited "
    "to, the implied warranties of merchantability and fitness for a particular purpose are disclaimed."
)
_GPL_NOTICE = (
    "<<var; match=\"this program | this library | this file | it\">> <<var; match=\"is free software you can | you can\">> redistribute it "
    "and/or modify it under the terms of the GNU {} Public License as published by the Free Software Foundation <<beginOptional>>either"
    "<<endOptional>> version {} <<beginOptional>>of the License<<endOptional>>"
)
# Public wordings of licenses and of notices that name them.
TEMPLATES = (
    ("MIT", _GRANT + "<<beginOptional>>Expat<<endOptional>> MIT license"),
    ("MIT", """
        Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
        files <<beginOptional>>(the "Software")<<endOptional>>, to deal in the Software without restriction, including without
        limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and
        to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright
        notice and this permission notice <<beginOptional>>(including the next paragraph)<<endOptional>> shall be included in all
        copies or substantial portions of the Software. The software is provided "as is", without warranty of any kind, express or
        implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and
        <<var; match="noninfringement | non infringement">>. In no event shall <<var; match=".{1,12}">> be liable for any claim,
        damages or other liability, whether in an action of contract, tort or otherwise, arising from, out of or in connection with
        the software or the use or other dealings in the software"""),
    ("ISC", """
        Permission to use, copy, modify, and<<beginOptional>>/or<<endOptional>> distribute this software for any purpose with or
        without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"""),
    ("ISC", _GRANT + "ISC license"),
    ("BSD-2-Clause", _SOURCE + _NO_WARRANTY),
    ("BSD-3-Clause", _SOURCE + """
        <<var; match=".{0,1}">> Neither the name<<beginOptional>>s<<endOptional>> of <<var; match=".{1,12}">> nor the names of
        <<var; match="its | their">> contributors may be used to endorse or promote products derived from this software without
        specific prior written permission. """ + _NO_WARRANTY),
    ("BSD-3-Clause", _GRANT + '<<var; match="BSD 3 clause | 3 clause BSD | new BSD | modified BSD">> license'),
    ("Apache-2.0", _GRANT + 'Apache <<beginOptional>>Software<<endOptional>> license <<var; match="version 2 0 | v2 0 | 2 0 | version 2">>'),
    ("Apache-2.0", """
        Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
        License. You may obtain a copy of the License at"""),
    ("GPL-2.0", _GRANT + 'GNU general public license <<beginOptional>>GPL<<endOptional>> <<var; match="version 2 | v2">>'),
    ("GPL-2.0", _GPL_NOTICE.format("General", "2")),
    ("GPL-3.0", _GRANT + 'GNU general public license <<beginOptional>>GPL<<endOptional>> <<var; match="version 3 | v3">>'),
    ("GPL-3.0", _GPL_NOTICE.format("General", "3")),
    ("LGPL-2.1", _GRANT + 'GNU lesser general public license <<var; match="version 2 1 | v2 1">>'),
    ("LGPL-3.0", _GRANT + 'GNU lesser general public license <<var; match="version 3 | v3">>'),
    ("LGPL-3.0", _GPL_NOTICE.format("Lesser General", "3")),
    ("AGPL-3.0", _GRANT + 'GNU affero general public license <<var; match="version 3 | v3">>'),
    ("MPL-2.0", """
        This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed
        with this file, You can obtain one at"""),
    ("CC-BY-4.0", _GRANT + '<<var; match="CC BY | Creative Commons Attribution">> 4.0'),
    ("CC-BY-SA-4.0", _GRANT + '<<var; match="CC BY SA | Creative Commons Attribution Sharealike">> 4.0'),
    ("CC-BY-NC-4.0", _GRANT + '<<var; match="CC BY NC | Creative Commons Attribution Noncommercial">> 4.0'),
    ("CC-BY-NC-SA-4.0", _GRANT + '<<var; match="CC BY NC SA | Creative Commons Attribution Noncommercial Sharealike">> 4.0'),
    ("CC0-1.0", _GRANT + '<<var; match="CC0 | Creative Commons Zero">> 1.0'),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0"),
)


class TemplateError(ValueError):
    """The markup of a template cannot be compiled."""


def words_of(text: str) -> list[str]:
    return [w.decode() for w in _WORD.findall(text.encode().translate(_LOWER))]


# A part of a parsed template: ("words", [..]), ("optional", [parts]), ("any", least, most) or ("one", [[word, ..], ..]).
Part = tuple


def parse(template: str) -> list[Part]:
    """The template's parts."""
    open_parts: list[list[Part]] = [[]]
    for k, piece in enumerate(_MARKUP.split(template)):
        tag = piece.split(";")[0].strip()
        if k % 2 == 0:
            if found := words_of(piece):
                open_parts[-1].append(("words", found))
        elif tag == "beginOptional":
            open_parts.append([])
        elif tag == "endOptional":
            if len(open_parts) == 1:
                raise TemplateError("an optional region ends that has not begun")
            inner = open_parts.pop()
            open_parts[-1].append(("optional", inner))
        elif tag == "var":
            match = re.search(r'match="(.*?)"', piece, re.S)
            if match is None:
                raise TemplateError(f"a replaceable region says nothing about what replaces it: {piece}")
            if bounds := _ANY.fullmatch(match[1].strip()):
                open_parts[-1].append(("any", int(bounds[1]), int(bounds[2])))
            else:
                open_parts[-1].append(("one", [words_of(x) for x in match[1].split("|")]))
        else:
            raise TemplateError(f"unknown markup: {piece}")
    if len(open_parts) > 1:
        raise TemplateError("an optional region does not end")
    return open_parts[0]


def mandatory(parts: Sequence[Part]) -> int:
    """How many words of the template's own wording a match has at least."""
    own = {"words": lambda p: len(p[1]), "optional": lambda p: 0, "any": lambda p: 0, "one": lambda p: min(map(len, p[1]))}
    return sum(own[p[0]](p) for p in parts)


def longest(parts: Sequence[Part]) -> int:
    most = {"words": lambda p: len(p[1]), "optional": lambda p: longest(p[1]), "any": lambda p: p[2], "one": lambda p: max(map(len, p[1]))}
    return sum(most[p[0]](p) for p in parts)


class Automaton:
    """All templates as one automaton over words; `templates` are parsed ones, known by their place in the list."""

    def __init__(self, templates: Sequence[Sequence[Part]]):
        self.by_word: list[dict[bytes, list[int]]] = []
        self.by_any: list[list[int]] = []
        self.free: list[list[int]] = []
        self.accepts: dict[int, int] = {}
        start = self._state()
        for k, parts in enumerate(templates):
            if not mandatory(parts):
                raise TemplateError("a template needs mandatory wording")
            first = self._state()
            self.free[start].append(first)
            self.accepts[self._add(parts, first)] = k
        self.span = max(map(longest, templates), default=0)
        self.first = self._closed([start])
        if any(self.by_any[s] for s in self.first):
            raise TemplateError("a template cannot begin with a region of any words")
        self.triggers = frozenset(w for s in self.first for w in self.by_word[s])
        self.alphabet = frozenset(w for edges in self.by_word for w in edges)
        self._forget()

    def _state(self) -> int:
        self.by_word.append({})
        self.by_any.append([])
        self.free.append([])
        return len(self.free) - 1

    def _chain(self, words: Iterable[str], at: int) -> int:
        for word in words:
            to = self._state()
            self.by_word[at].setdefault(word.encode(), []).append(to)
            at = to
        return at

    def _add(self, parts: Sequence[Part], at: int) -> int:
        """Edges for the parts, from a state on; returns the state behind them."""
        for part in parts:
            if part[0] == "words":
                at = self._chain(part[1], at)
                continue
            end = self._state()
            if part[0] == "optional":
                self.free[at].append(end)
                self.free[self._add(part[1], at)].append(end)
            elif part[0] == "one":
                for words in part[1]:
                    self.free[self._chain(words, at)].append(end)
            else:
                for n in range(part[2] + 1):
                    if n >= part[1]:
                        self.free[at].append(end)
                    if n < part[2]:
                        to = self._state()
                        self.by_any[at].append(to)
                        at = to
            at = end
        return at

    def _closed(self, states: Iterable[int]) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for to in self.free[todo.pop()]:
                if to not in seen:
                    seen.add(to)
                    todo.append(to)
        return frozenset(seen)

    def _forget(self) -> None:
        self.sets = [self.first]
        self.number = {self.first: 0}
        self.steps: list[dict[bytes | None, int]] = [{}]
        self.ends: list[tuple[int, ...]] = [self._ends(self.first)]

    def _ends(self, states: frozenset[int]) -> tuple[int, ...]:
        return tuple(sorted(self.accepts[s] for s in states if s in self.accepts))

    def _step(self, state: int, word: bytes | None) -> int:
        """The number of the set of states that follows; -1 if there is none."""
        to: set[int] = set()
        for s in self.sets[state]:
            to.update(self.by_any[s])
            to.update(self.by_word[s].get(word, ()) if word is not None else ())
        if not to:
            found = -1
        else:
            states = self._closed(to)
            found = self.number.get(states, -1)
            if found < 0:
                found = self.number[states] = len(self.sets)
                self.sets.append(states)
                self.steps.append({})
                self.ends.append(self._ends(states))
        self.steps[state][word] = found
        return found

    def at(self, words: Sequence[bytes], place: int) -> set[int]:
        """The templates that a run of words from this place on matches."""
        if len(self.sets) > REMEMBERED:
            self._forget()
        found: set[int] = set()
        state = 0
        for k in range(place, min(len(words), place + self.span)):
            word = words[k] if words[k] in self.alphabet else None
            after = self.steps[state].get(word)
            state = self._step(state, word) if after is None else after
            if state < 0:
                break
            found.update(self.ends[state])
        return found

    def search(self, text: bytes) -> tuple[int, list[tuple[int, set[int]]]]:
        """The number of words, and the places at which templates match, with these templates."""
        words: list[bytes] = []
        passed, found, at = 0, [], 0
        while at < len(text):
            gap = _GAP.search(text, min(len(text), at + PIECE))
            end = gap.start() if gap else len(text)
            words += _WORD.findall(text[at:end].translate(_LOWER))
            done = len(words) if end == len(text) else max(0, len(words) - self.span)
            for place in (k for k, w in enumerate(words[:done]) if w in self.triggers):
                if hit := self.at(words, place):
                    found.append((passed + place, hit))
            del words[:done]
            passed += done
            at = end
        return passed, found


def scan(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, and the places of the templates' wordings.

    `templates` are pairs of a label and a template. `found` has (place, label) of each accepted wording, phrases included.
    """
    phrases = len(PHRASES)
    labels = [label for _, label in PHRASES] + [label for label, _ in templates]
    parsed = [parse(text) for text, _ in PHRASES] + [parse(text) for _, text in templates]
    weights = [mandatory(x) for x in parsed]
    # Compiled once in a worker; the sets of states it meets stay for the next batch.
    held: list[Automaton] = []

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not held:
            held.append(Automaton(parsed))
        rows = []
        for text in common.raw_bytes(batch["text"]):
            n_words, found = held[0].search(text)
            base = [(place, k) for place, hit in found for k in hit if k < phrases]
            every = {k for _, hit in found for k in hit}
            strongest = max((weights[k] for k in every), default=0)
            rows.append((
                n_words, len(base), min(base)[0] if base else None, max(base)[0] if base else None,
                ",".join(sorted({labels[k] for _, k in base})), ",".join(sorted({labels[k] for k in every})),
                strongest / (strongest + _HALF), [{"place": place, "label": labels[k]} for place, hit in found for k in sorted(hit)],
            ))
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(),
                 pa.list_(pa.struct([("place", pa.int64()), ("label", pa.string())])))
        columns = [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)]
        return pa.RecordBatch.from_arrays([batch["doc_id"], *columns], names)

    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "found"]
    schema = (
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
        "found array<struct<place:long,label:string>>"
    )
    return common.map_arrow(common.texts_of(docs), step, schema)


def as_regex(parts: Sequence[Part]) -> str:
    """The same wording as a regular expression over words that each have a space behind them; it is what tests and SQL use."""
    kinds = {
        "words": lambda p: "".join(f"{w} " for w in p[1]),
        "optional": lambda p: f"(?:{as_regex(p[1])})?",
        "any": lambda p: f"(?:[^ ]+ ){{{p[1]},{p[2]}}}",
        "one": lambda p: "(?:" + "|".join("".join(f"{w} " for w in x) for x in p[1]) + ")",
    }
    return "".join(kinds[p[0]](p) for p in parts)
