"""Operator 4, licence scan with a generalised suffix automaton.

The automaton holds all licence templates and the base phrases. A text is
streamed through it; the state after each word is the longest run of words
ending there that occurs in some template (the matching statistic). Long
matches that follow each other in the same template are chained into spans, and
a template whose words are covered to a good part gives its label. A base
phrase stands wherever the current match ends with the whole phrase, which the
suffix links of the automaton tell.

Only runs of words whose neighbouring pairs all occur in a template can carry a
match of two or more words, so the pairs are looked up for whole batches at
once and the automaton walks over those runs alone.

Cases: null or empty text has no words, no labels and score 0; texts of any
length are scanned whole; rows that repeat an id are scanned one by one; an
empty table gives an empty result; other columns are not passed on.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ALNUM, LOWER, UPPER, hash_words, map_batches, words_of

# The phrases whose places are counted, with their labels.
BASE_PHRASES: dict[str, str] = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Opening or grant wording of public licences.
TEMPLATES: dict[str, str] = {
    "apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at""",
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "gpl-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-notice": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation, either version 3 of the License, or (at
        your option) any later version.""",
    "lgpl-notice": """This library is free software; you can redistribute it and/or modify it under the terms of the GNU
        Lesser General Public License as published by the Free Software Foundation""",
    "agpl-3.0": "GNU Affero General Public License as published by the Free Software Foundation",
    "mit-release": "Released under the MIT License.",
    "mit-grant": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including without
        limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
        Software""",
    "bsd": """Redistribution and use in source and binary forms, with or without modification, are permitted provided
        that the following conditions are met""",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "cc-by-4.0": "Licensed under CC BY 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-nd-4.0": "Licensed under CC BY-ND 4.0.",
    "cc-by-deed": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc0-1.0": "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
}

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = str.maketrans(UPPER, LOWER)


def words(text: str) -> list[str]:
    """Words of a text with A-Z lower-cased."""
    return _WORD.findall(text.translate(_LOWER))


@dataclass
class Automaton:
    """Generalised suffix automaton over word sequences."""

    length: list[int] = field(default_factory=lambda: [0])
    link: list[int] = field(default_factory=lambda: [-1])
    step: list[dict[int, int]] = field(default_factory=lambda: [{}])
    #: templates that contain the state's words: template -> an end position
    ends: list[dict[int, int]] = field(default_factory=lambda: [{}])
    sequences: list[tuple[tuple[int, ...], int]] = field(default_factory=list)

    def _state(self, length: int, link: int, step: dict[int, int], ends: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.step.append(step)
        self.ends.append(ends)
        return len(self.length) - 1

    def _split(self, parent: int, child: int, word: int) -> int:
        clone = self._state(self.length[parent] + 1, self.link[child], dict(self.step[child]), {})
        self.link[child] = clone
        while parent >= 0 and self.step[parent].get(word) == child:
            self.step[parent][word] = clone
            parent = self.link[parent]
        return clone

    def _extend(self, last: int, word: int) -> int:
        known = self.step[last].get(word)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._split(last, known, word)
        new = self._state(self.length[last] + 1, 0, {}, {})
        at = last
        while at >= 0 and word not in self.step[at]:
            self.step[at][word] = new
            at = self.link[at]
        if at >= 0:
            child = self.step[at][word]
            self.link[new] = child if self.length[child] == self.length[at] + 1 else self._split(at, child, word)
        return new

    def add(self, sequence: Sequence[int], template: int) -> None:
        state = 0
        for word in sequence:
            state = self._extend(state, word)
        self.sequences.append((tuple(sequence), template))

    def finish(self) -> None:
        """Note for every state one end position in each template that holds its words."""
        for sequence, template in self.sequences:
            state = 0
            for at, word in enumerate(sequence):
                state = self.step[state][word]
                up = state
                while up > 0 and template not in self.ends[up]:
                    self.ends[up][template] = at
                    up = self.link[up]


@dataclass
class Span:
    """A stretch of text that follows a template."""

    template: int
    first: int  # first word in the text
    last: int
    covered: int  # template words in it


@dataclass
class Scanner:
    """The automaton with its word numbers, base phrases and template labels."""

    labels: list[str]
    sizes: list[int]
    base: list[tuple[int, str, int]]  # (state, label, words)
    automaton: Automaton
    word_hash: np.ndarray
    word_number: np.ndarray
    pair_hash: np.ndarray
    min_match: int
    max_gap: int
    min_cover: float

    @classmethod
    def build(cls, templates: dict[str, str], base: dict[str, str], min_match: int, max_gap: int, min_cover: float) -> Scanner:
        texts = [words(t) for t in templates.values()]
        phrases = [words(p) for p in base]
        vocabulary = sorted({w for t in [*texts, *phrases] for w in t})
        number = {w: i for i, w in enumerate(vocabulary)}
        machine = Automaton()
        for i, t in enumerate([*texts, *phrases]):
            machine.add([number[w] for w in t], i)
        machine.finish()
        ends = []
        for p, label in zip(phrases, base.values()):
            state = 0
            for w in p:
                state = machine.step[state][number[w]]
            ends.append((state, label, len(p)))
        hashes = hash_words(vocabulary)
        order = np.argsort(hashes)
        pairs = {(number[a], number[b]) for t in [*texts, *phrases] for a, b in zip(t, t[1:])}
        pair_hash = np.sort(np.array([a * len(vocabulary) + b for a, b in pairs], dtype=np.int64))
        return cls(list(templates), [len(t) for t in texts], ends, machine, hashes[order], order.astype(np.int64), pair_hash, min_match, max_gap, min_cover)

    def runs(self, hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(numbers of all words or -1, first, last) of the runs worth a walk."""
        at = np.minimum(np.searchsorted(self.word_hash, hashes), len(self.word_hash) - 1)
        number = np.where(self.word_hash[at] == hashes, self.word_number[at], -1)
        if len(number) < 2:
            return number, np.zeros(0, int), np.zeros(0, int)
        pair = number[:-1] * len(self.word_hash) + number[1:]
        k = np.minimum(np.searchsorted(self.pair_hash, pair), len(self.pair_hash) - 1)
        good = (number[:-1] >= 0) & (number[1:] >= 0) & (self.pair_hash[k] == pair)
        cuts = bounds[(bounds > 0) & (bounds < len(number))]
        good[cuts - 1] = False  # the last word of a row has no neighbour
        edge = np.diff(np.concatenate([[0], good.astype(np.int8), [0]]))
        return number, np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)

    def walk(self, numbers: Sequence[int], first: int) -> tuple[list[tuple[int, int]], list[Span]]:
        """Matches in one run that starts at word ``first`` of its text: the
        base phrases as (phrase, start word), and maximal matches as spans."""
        machine = self.automaton
        step, link, length = machine.step, machine.link, machine.length
        found, spans = [], []
        state = matched = 0
        for i, word in enumerate(numbers):
            before = (state, matched)
            while state and word not in step[state]:
                state = link[state]
                matched = length[state]
            if word in step[state]:
                state = step[state][word]
                matched += 1
            if before[1] >= self.min_match and matched <= before[1]:
                self._note(before, first + i - 1, spans)
            for p, (end, _, size) in enumerate(self.base):
                if matched >= size and self._ends_with(state, end):
                    found.append((p, first + i - size + 1))
        if matched >= self.min_match:
            self._note((state, matched), first + len(numbers) - 1, spans)
        return found, spans

    def _ends_with(self, state: int, end: int) -> bool:
        """The words of ``end`` are a suffix of the match in ``state``."""
        floor = self.automaton.length[end]
        while self.automaton.length[state] > floor:
            state = self.automaton.link[state]
        return state == end

    def _note(self, match: tuple[int, int], last: int, spans: list[Span]) -> None:
        state, matched = match
        for template in self.automaton.ends[state]:
            if template < len(self.sizes):
                spans.append(Span(template, last - matched + 1, last, matched))

    def chain(self, spans: list[Span]) -> list[Span]:
        """Join matches of one template that follow each other closely."""
        out: list[Span] = []
        open_spans: dict[int, Span] = {}
        for s in sorted(spans, key=lambda s: (s.first, s.last)):
            o = open_spans.get(s.template)
            if o is not None and s.first <= o.last + 1 + self.max_gap:
                fresh = max(0, s.last - max(o.last, s.first - 1))
                o.covered = min(self.sizes[s.template], o.covered + fresh)
                o.last = max(o.last, s.last)
            else:
                open_spans[s.template] = o = Span(s.template, s.first, s.last, s.covered)
                out.append(o)
        return out

    def verdict(self, spans: list[Span]) -> tuple[set[str], float]:
        """Labels of templates covered well enough, and the best cover. Among
        templates whose spans overlap, only the best covered one counts."""
        ranked = sorted(spans, key=lambda s: (-s.covered / self.sizes[s.template], -s.covered, s.template))
        labels, taken, best = set(), [], 0.0
        for s in ranked:
            cover = s.covered / self.sizes[s.template]
            best = max(best, cover)
            if cover >= self.min_cover and not any(s.first <= t.last and t.first <= s.last for t in taken):
                labels.add(self.labels[s.template])
                taken.append(s)
        return labels, min(1.0, best)


def license_scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: dict[str, str] | None = None,
    base: dict[str, str] | None = None,
    min_match: int = 3,
    max_gap: int = 8,
    min_cover: float = 0.7,
) -> DataFrame:
    """One row per document: id, ``n_words``, ``n_base``, ``first_word``,
    ``last_word``, ``base_labels``, ``labels``, ``score`` and ``spans``
    (label, first word, last word, covered share)."""
    scanner = Scanner.build(templates or TEMPLATES, base or BASE_PHRASES, min_match, max_gap, min_cover)
    id_type = dict(docs.dtypes)[id_col]

    def run(batch: pa.RecordBatch):
        n = batch.num_rows
        n_words = np.zeros(n, np.int64)
        places: dict[int, list[tuple[int, int]]] = {}
        matches: dict[int, list[Span]] = {}
        for w in words_of(batch.column(1), ALNUM):
            n_words[w.first_row : w.first_row + w.rows] = np.diff(w.bounds)
            number, first, last = scanner.runs(w.hash, w.bounds)
            rows = np.searchsorted(w.bounds, first, side="right") - 1
            for a, b, row in zip(first.tolist(), last.tolist(), rows.tolist()):
                found, spans = scanner.walk(number[a : b + 1].tolist(), a - int(w.bounds[row]))
                if found:
                    places.setdefault(w.first_row + row, []).extend(found)
                if spans:
                    matches.setdefault(w.first_row + row, []).extend(spans)
        n_base, first_word, last_word, base_labels, labels, score, covered = [], [], [], [], [], [], []
        for i in range(n):
            found = places.get(i, ())
            spans = scanner.chain(matches[i]) if i in matches else []
            more, best = scanner.verdict(spans)
            own = {scanner.base[p][1] for p, _ in found}
            starts = [s for _, s in found]
            n_base.append(len(found))
            first_word.append(min(starts, default=None))
            last_word.append(max(starts, default=None))
            base_labels.append(",".join(sorted(own)))
            labels.append(",".join(sorted(own | more)))
            score.append(1.0 if own else best)
            covered.append([{"label": scanner.labels[s.template], "first": s.first, "last": s.last, "cover": s.covered / scanner.sizes[s.template]} for s in spans])
        span_type = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("cover", pa.float64())]))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(n_words),
                pa.array(n_base, pa.int64()),
                pa.array(first_word, pa.int64()),
                pa.array(last_word, pa.int64()),
                pa.array(base_labels, pa.string()),
                pa.array(labels, pa.string()),
                pa.array(score, pa.float64()),
                pa.array(covered, span_type),
            ],
            names=["id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"],
        )

    schema = (
        f"id {id_type}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
        "spans array<struct<label: string, first: long, last: long, cover: double>>"
    )
    out = map_batches(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), run, schema)
    return out.withColumnRenamed("id", id_col)
