"""Licence scans with a generalised suffix automaton over licence words.

The automaton holds every word sequence that occurs in any template. Streaming a file
through it gives, per word, the length of the longest template sequence that ends there
(matching statistics) and where in the templates it ends; its suffixes end at further places.
At each place a match is taken where the template goes on otherwise than the file. Long
matches that follow one another both in the file and in a template are chained; a chain that
covers enough of its template is a span of that licence, unless it is but a part of another.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame

from shopledger.llm.common import by_batch

# Phrases that count wherever their words stand consecutively.
BASE_PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)
# Sentences and paragraphs that licences ask to be kept with a work, and tags. A licence that differs
# from another by a word has a template of its own, whose span then holds the other's.
TEMPLATES = (
    ("mit", "SPDX-License-Identifier: MIT"),
    ("apache-2", "SPDX-License-Identifier: Apache-2.0"),
    ("bsd", "SPDX-License-Identifier: BSD-3-Clause"),
    ("mpl-2", "SPDX-License-Identifier: MPL-2.0"),
    ("gpl-2", "SPDX-License-Identifier: GPL-2.0-only"),
    ("gpl-3", "SPDX-License-Identifier: GPL-3.0-only"),
    ("lgpl-3", "SPDX-License-Identifier: LGPL-3.0-only"),
    ("agpl-3", "SPDX-License-Identifier: AGPL-3.0-only"),
    ("isc", "SPDX-License-Identifier: ISC"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files, to deal in the Software without restriction, including without limitation the rights to "
            "use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    ("apache-2", "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
                 "http://www.apache.org/licenses/LICENSE-2.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nd", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License"),
    ("cc-by-nc-sa", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"),
    ("cc-by-nc-nd", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"),
    ("cc0", "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to "
            "this software to the public domain worldwide"),
    ("cc0", "CC0 1.0 Universal Public Domain Dedication"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3"),
    ("lgpl-3", "This work is licensed under the GNU Lesser General Public License, version 3"),
    ("agpl-3", "This work is licensed under the GNU Affero General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation"),
    ("lgpl", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General "
             "Public License as published by the Free Software Foundation"),
    ("agpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
             "Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("epl-2", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies"),
)

MIN_MATCH = 4
MAX_GAP = 6
MIN_COVERAGE = 0.8

# Bytes of words: digits, letters (A-Z lower-cased) and all that is not ASCII.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


# A long text is read in pieces of about so many bytes, which bounds the memory of a task.
PIECE = 1 << 20


def pieces_of(text: bytes | str | None) -> Iterator[list[bytes]]:
    """The words of a text, piece by piece; a piece ends between words."""
    raw = (text.encode() if isinstance(text, str) else text or b"").translate(_WORD_BYTES)
    at = 0
    while at < len(raw):
        cut = raw.find(b" ", at + PIECE)
        end = len(raw) if cut < 0 else cut
        yield raw[at:end].split()
        at = end


def words_of(text: bytes | str | None) -> list[bytes]:
    return [word for piece in pieces_of(text) for word in piece]


@dataclass
class Automaton:
    """A generalised suffix automaton: per state the longest length, the suffix link and the moves."""

    templates: list[tuple[str, list[bytes]]]
    phrases: list[tuple[str, list[bytes]]]
    ids: dict[bytes, int] = field(default_factory=dict)
    length: list[int] = field(default_factory=lambda: [0])
    link: list[int] = field(default_factory=lambda: [-1])
    moves: list[dict[int, int]] = field(default_factory=lambda: [{}])

    def __post_init__(self) -> None:
        ends: dict[int, list[tuple[int, int]]] = {}
        sequences = [words for _, words in self.phrases + self.templates]
        for number, words in enumerate(sequences):
            state = 0
            for position, word in enumerate(words):
                state = self._extend(state, self.ids.setdefault(word, len(self.ids)))
                ends.setdefault(state, []).append((number, position))
        # Places where a state's sequences end, inherited by the suffixes; long states first.
        self.places: list[list[tuple[int, int]]] = [ends.get(s, []) for s in range(len(self.length))]
        order = sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True)
        for state in order:
            if (up := self.link[state]) > 0:
                self.places[up] = sorted({*self.places[up], *self.places[state]})
        # Per state and place: the length of the match there (0: that of the state), the place, and the template's next word.
        after = [[self.ids[word] for word in words[1:]] + [-2] for words in sequences]
        self.matches: list[list[tuple[int, int, int, int]]] = [[] for _ in self.length]
        for state in reversed(order):
            mine = [(0, n, p, after[n][p]) for n, p in self.places[state]]
            up, held = self.link[state], {*self.places[state]}
            further = [(size or self.length[up], n, p, word) for size, n, p, word in self.matches[up] if (n, p) not in held]
            self.matches[state] = mine + [m for m in further if m[0] >= MIN_MATCH]
        own: dict[int, list[int]] = {}
        for number, (_, words) in enumerate(self.phrases):
            state = 0
            for word in words:
                state = self.moves[state][self.ids[word]]
            own.setdefault(state, []).append(number)
        self.endings: list[list[int]] = [[] for _ in self.length]
        for state in reversed(order):
            self.endings[state] = own.get(state, []) + self.endings[self.link[state]]

    def _extend(self, last: int, word: int) -> int:
        if word in self.moves[last]:
            there = self.moves[last][word]
            if self.length[there] == self.length[last] + 1:
                return there
            return self._clone(last, word, there)
        new = self._state(self.length[last] + 1, {})
        at = last
        while at != -1 and word not in self.moves[at]:
            self.moves[at][word] = new
            at = self.link[at]
        if at == -1:
            self.link[new] = 0
        else:
            there = self.moves[at][word]
            exact = self.length[there] == self.length[at] + 1
            self.link[new] = there if exact else self._clone(at, word, there)
        return new

    def _state(self, length: int, moves: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(0)
        self.moves.append(moves)
        return len(self.length) - 1

    def _clone(self, at: int, word: int, there: int) -> int:
        copy = self._state(self.length[at] + 1, dict(self.moves[there]))
        self.link[copy] = self.link[there]
        self.link[there] = copy
        while at != -1 and self.moves[at].get(word) == there:
            self.moves[at][word] = copy
            at = self.link[at]
        return copy

    def statistics(self, ids: list[int]) -> tuple[list[int], list[int]]:
        """Per word the longest match that ends there, and its state."""
        state, matched, lengths, states = 0, 0, [], []
        moves, link, length = self.moves, self.link, self.length
        for word in ids:
            while state and word not in moves[state]:
                state = link[state]
                matched = length[state]
            if word in moves[state]:
                state = moves[state][word]
                matched += 1
            lengths.append(matched)
            states.append(state)
        return lengths, states

    def known_runs(self, pieces: Iterable[list[bytes]], least: int) -> Iterator[tuple[int, list[int]]]:
        """Runs of at least ``least`` template words: first position and word numbers.

        Last comes the number of all words, with an empty run.
        """
        get, done, held = self.ids.get, 0, np.zeros(0, np.int32)
        for words in pieces:
            # A run at the end of a piece goes on in the next one.
            ids = np.concatenate((held, np.fromiter((get(w, -1) for w in words), np.int32, len(words))))
            offset, done = done - len(held), done + len(words)
            inside = np.concatenate(([False], ids >= 0, [False]))
            edges = np.flatnonzero(inside[1:] != inside[:-1])
            held = ids[edges[-2] :] if len(edges) and edges[-1] == len(ids) else ids[:0]
            for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
                if end - start >= least and end < len(ids):
                    yield offset + start, ids[start:end].tolist()
        if len(held) >= least:
            yield done - len(held), held.tolist()
        yield done, []

    def scan(
        self, pieces: Iterable[list[bytes]]
    ) -> tuple[int, list[tuple[int, int, str]], list[tuple[int, int, str, float, tuple]]]:
        """Number of words, base phrases ``(first, end, label)``, template spans ``(first, end, label, coverage, matched)``."""
        base: list[tuple[int, int, str]] = []
        offset = 0
        chains = _Chains([len(w) for _, w in self.phrases + self.templates])
        shortest = min((len(w) for _, w in self.phrases), default=MIN_MATCH)
        for offset, ids in self.known_runs(pieces, min(shortest, MIN_MATCH)):
            lengths, states = self.statistics(ids)
            for i, (size, state) in enumerate(zip(lengths, states)):
                for number in self.endings[state]:
                    label, phrase = self.phrases[number]
                    if size >= len(phrase):
                        base.append((offset + i + 1 - len(phrase), offset + i + 1, label))
                if size >= MIN_MATCH:
                    following = ids[i + 1] if i + 1 < len(ids) else -1
                    for length, number, position, word in self.matches[state]:
                        # A match that goes on is taken where it ends.
                        if word != following:
                            length = length or size
                            chains.add(number, offset + i + 1 - length, offset + i + 1, position + 1 - length, position + 1)
        labels = [label for label, _ in self.phrases + self.templates]
        return offset, base, [(first, end, labels[number], *rest) for number, first, end, *rest in chains.closed()]


class _Chains:
    """Matches of a template that follow one another in the file and in the template."""

    def __init__(self, sizes: list[int]):
        self.sizes, self.open, self.done = sizes, {}, []

    def add(self, number: int, first: int, end: int, t_first: int, t_end: int) -> None:
        live, grown = [], None
        for chain in self.open.get(number, []):
            if first - chain[1] > MAX_GAP:
                self.done.append((number, *chain))
                continue
            # A match that overlaps the chain counts by what it adds.
            over = max(0, chain[1] - first, chain[2] - t_first)
            if t_first - chain[2] <= MAX_GAP and over < end - first and (not grown or chain[3] > grown[3]):
                grown = [chain[0], end, t_end, chain[3] + end - first - over, (*chain[4], (first + over, end))]
            live.append(chain)
        live.append(grown or [first, end, t_end, end - first, ((first, end),)])
        # Of chains that end at one place, the one with more coverage can only do better.
        best = {}
        for chain in live:
            key = (chain[1], chain[2])
            if key not in best or chain[3] > best[key][3]:
                best[key] = chain
        self.open[number] = list(best.values())

    def closed(self) -> list[tuple[int, int, int, float, tuple]]:
        """``(template, first, end, coverage, matched parts)`` of the best chains that do not overlap."""
        rest = [(n, *c) for n, chains in self.open.items() for c in chains]
        ranked = sorted(self.done + rest, key=lambda c: (-c[4] / self.sizes[c[0]], c[1], c[0]))
        spans, taken = [], {}
        for number, first, end, _, covered, matched in ranked:
            mine = taken.setdefault(number, [])
            at = bisect_left(mine, (first, end))
            if (at == 0 or mine[at - 1][1] <= first) and (at == len(mine) or end <= mine[at][0]):
                mine.insert(at, (first, end))
                spans.append((number, first, end, min(1.0, covered / self.sizes[number]), matched))
        return spans


def own_spans(spans: list[tuple[int, int, str, float, tuple]]) -> list[tuple[int, int, str, float, tuple]]:
    """The spans without those that are only a part of another.

    Such a span has words left out or inserted, and all its words are in a span with more
    words, or in one that covers more of its template. So the attribution licence is not found
    in the text of the non-commercial one, which has a word more, nor the other way round.
    """
    kept, near = [], []
    words = [{w for first, end in matched for w in range(first, end)} for *_, matched in spans]
    # What holds a span starts before it, or there and has more words.
    for i in sorted(range(len(spans)), key=lambda i: (spans[i][0], -len(words[i]), -spans[i][3])):
        first, end, _, coverage, _ = spans[i]
        near = [j for j in near if spans[j][1] > first]
        exact = coverage == 1.0 and len(words[i]) == end - first
        if exact or not any(words[i] < words[j] or (words[i] == words[j] and coverage < spans[j][3]) for j in near):
            kept.append(spans[i])
        near.append(i)
    return kept


def automaton(
    phrases: tuple[tuple[str, str], ...] = BASE_PHRASES, templates: tuple[tuple[str, str], ...] = TEMPLATES
) -> Automaton:
    return Automaton(*[[(label, words_of(text)) for label, text in given] for given in (templates, phrases)])


def scan(documents: DataFrame, licences: Automaton | None = None, min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """Licence findings per row of ``documents(doc_id, text, ...)``.

    Columns: ``doc_id``, ``n_words``, ``n_base`` (places of base phrases, overlapping ones
    too), ``first_word`` and ``last_word`` (their smallest and largest start, else null),
    ``base_labels`` and ``labels`` (distinct, sorted, comma-joined; ``labels`` also those of
    template spans), ``score`` (the largest coverage of any template; 1 with a base phrase,
    0 without any match), ``spans`` (``label:first:end`` in words, by place).

    Null and empty texts have no word and no finding. Rows stay as they are, repeated ones
    and null ids too; other columns are ignored, whatever their names.
    """
    tool = licences or automaton()

    def work(ids: list, texts: list) -> Iterator[dict]:
        made = {name: [] for name in names}
        for doc, text in zip(ids, texts):
            n_words, base, spans = tool.scan(pieces_of(text))
            starts = [first for first, _, _ in base]
            covered = own_spans([s for s in spans if s[3] >= min_coverage])
            found = sorted({(a, b, label) for a, b, label, *_ in [*base, *covered]})
            row = (
                doc, n_words, len(base), min(starts, default=None), max(starts, default=None),
                ",".join(sorted({label for _, _, label in base})), ",".join(sorted({label for _, _, label in found})),
                1.0 if base else max((s[3] for s in spans), default=0.0),
                ",".join(f"{label}:{a}:{b}" for a, b, label in found),
            )
            for name, value in zip(names, row):
                made[name].append(value)
        yield made

    schema = (
        "doc_id long, n_words long, n_base long, first_word long, last_word long, "
        "base_labels string, labels string, score double, spans string"
    )
    names = [column.split()[0] for column in schema.split(", ")]
    return by_batch(documents.select(documents["doc_id"].cast("long").alias("doc_id"), "text"), ["doc_id", "text"], work, schema)
