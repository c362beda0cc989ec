"""Licence scans: matching statistics of a generalised suffix automaton, chained into covered template spans."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import slices, with_fields
from .words import raw_texts, words

# Phrases whose every place counts, and their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
# Public licence notices, by label.
TEMPLATES = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed "
        "on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Licensed under the BSD 3-Clause License",
    ),
    "cc-by-nc": ("Licensed under CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    "cc-by-sa": ("Licensed under CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    "gpl-3.0": (
        "This work is licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "mit": (
        "Released under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction",
    ),
    "mpl-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
}
#: Shortest match that is chained (a shorter template counts whole), most words between two matches, and the
#: part of a template's words that a chain has to cover.
LONG, GAP, COVERED = 3, 12, 0.75


class Automaton:
    """Generalised suffix automaton over the word numbers of templates and phrases."""

    def __init__(self, phrases: dict[str, str], templates: dict[str, tuple[str, ...]]):
        self.numbers: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[list[tuple[int, int]]] = [[]]
        self.templates: list[tuple[str, int]] = []  # label and size
        self.phrases: list[tuple[str, int]] = []
        for label, texts in sorted(templates.items()):
            for text in texts:
                sequence = self._numbers(text)
                self._add(sequence, len(self.templates), ends)
                self.templates.append((label, len(sequence)))
        places = []
        for text, label in phrases.items():
            sequence = self._numbers(text)
            self._add(sequence, None, ends)
            self.phrases.append((label, len(sequence)))
            places.append(sequence)
        # A state ends wherever the states ending in it end, so places move along the suffix links, longest first.
        order = sorted(range(1, len(self.next)), key=lambda v: -self.length[v])
        found = [set(e) for e in ends]
        for v in order:
            found[self.link[v]] |= found[v]
        self.ends = [sorted(e) for e in found]
        # Phrases that are suffixes of a state's longest string.
        own: list[list[int]] = [[] for _ in self.next]
        for p, sequence in enumerate(places):
            v = 0
            for c in sequence:
                v = self.next[v][c]
            own[v].append(p)
        self.suffixes: list[tuple[int, ...]] = [()] * len(self.next)
        for v in reversed(order):
            self.suffixes[v] = (*own[v], *self.suffixes[self.link[v]])

    def _numbers(self, text: str) -> list[int]:
        return [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words(text.encode())]

    def _state(self, length: int, like: int | None, ends: list) -> int:
        self.next.append(dict(self.next[like]) if like is not None else {})
        self.link.append(self.link[like] if like is not None else 0)
        self.length.append(length)
        ends.append([])
        return len(self.next) - 1

    def _split(self, p: int, q: int, c: int, ends: list) -> int:
        """The state of the string of p followed by c, taken apart from q if q's strings are longer."""
        if self.length[q] == self.length[p] + 1:
            return q
        new = self._state(self.length[p] + 1, q, ends)
        self.link[q] = new
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = new
            p = self.link[p]
        return new

    def _add(self, sequence: list[int], template: int | None, ends: list) -> None:
        last = 0
        for i, c in enumerate(sequence):
            if c in self.next[last]:
                last = self._split(last, self.next[last][c], c, ends)
            else:
                new, p = self._state(self.length[last] + 1, None, ends), last
                while p >= 0 and c not in self.next[p]:
                    self.next[p][c] = new
                    p = self.link[p]
                self.link[new] = 0 if p < 0 else self._split(p, self.next[p][c], c, ends)
                last = new
            if template is not None:
                ends[last].append((template, i))

    def scan(self, tokens: list[bytes]) -> tuple[list[tuple[int, int]], list[tuple[int, int, int]]]:
        """Places (start, phrase) of phrases, and long matches (first word, size, state) that no later word extends.

        Streams the words once; the matching statistic of a word is the length of the longest string of the
        automaton that ends there. A word that no template has resets it, so runs of known words are streamed alone.
        """
        known = np.fromiter(map(self.numbers.get, tokens, repeat(0)), np.int64, len(tokens))
        on = np.concatenate([[False], known > 0, [False]])
        edges = np.flatnonzero(on[1:] != on[:-1])
        places, matches = [], []
        for begin, end in edges.reshape(-1, 2)[np.diff(edges)[::2] > 1].tolist() if len(edges) else ():
            v, size = 0, 0
            for i, c in enumerate(known[begin:end].tolist(), begin):
                if c not in self.next[v]:
                    if size >= LONG:
                        matches.append((i - size, size, v))
                    while v and c not in self.next[v]:
                        v = self.link[v]
                        size = self.length[v]
                if c in self.next[v]:
                    v = self.next[v][c]
                    size += 1
                for p in self.suffixes[v]:
                    if size >= self.phrases[p][1]:
                        places.append((i - self.phrases[p][1] + 1, p))
            if size >= LONG:
                matches.append((end - size, size, v))
        return places, matches

    def spans(self, matches: list[tuple[int, int, int]]) -> list[tuple[str, int, int, float]]:
        """(label, first word, last word, covered part) of the chains of matches that cover enough of a template."""
        by_template: dict[int, list[tuple[int, int, int]]] = {}
        for start, size, state in matches:
            for template, end in self.ends[state]:
                by_template.setdefault(template, []).append((start, end - size + 1, size))
        out = []
        for template, parts in by_template.items():
            label, whole = self.templates[template]
            parts = sorted(set(parts))
            best: list[tuple[int, int]] = []  # covered words and first word of the best chain that ends with a part
            for n, (at, place, size) in enumerate(parts):
                cover, first = size, at
                for m in range(n - 1, -1, -1):
                    before, its, length = parts[m]
                    if at - before - length > GAP + whole:
                        break
                    skipped = max(0, before + length - at, its + length - place)  # words that both matches have
                    if before < at and its < place and at - before - length <= GAP and best[m][0] + size - skipped > cover:
                        cover, first = best[m][0] + size - skipped, best[m][1]
                best.append((cover, first))
                if cover >= COVERED * whole:
                    out.append((label, first, at + size - 1, cover / whole))
        return _longest(out)


def _longest(spans: list[tuple[str, int, int, float]]) -> list[tuple[str, int, int, float]]:
    """Of overlapping spans of one label the one that covers most."""
    kept: list[tuple[str, int, int, float]] = []
    for span in sorted(spans, key=lambda s: (s[0], -s[3], s[1], -s[2])):
        if not any(k[0] == span[0] and k[1] <= span[2] and span[1] <= k[2] for k in kept):
            kept.append(span)
    return sorted(kept, key=lambda s: (s[1], s[0]))


SPAN = "struct<label:string,first_word:long,last_word:long,covered:double>"
SPAN_TYPE = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("covered", pa.float64())]))


def scan_licenses(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases: dict[str, str] | None = None, templates: dict[str, tuple[str, ...]] | None = None
) -> DataFrame:
    """One row per input row: id, ``n_words``, ``n_base`` (places of base phrases), ``first_word`` and ``last_word`` (their
    smallest and largest start, else null), ``base_labels``, ``labels`` (base and template labels), ``score`` and ``spans``.

    A place of a phrase is where its words stand consecutively. A template is found where a chain of
    long matches, in the order of the template and near each other, covers ``COVERED`` of its words. ``score`` is 1
    with a base phrase, else the largest covered part, else 0.

    Null and empty texts have no words and no places. Texts are streamed whole; the automaton is built from the fixed
    notices, so its size does not follow the data. Other columns are not read; an empty table gives an
    empty result. No shuffle.
    """
    rows = docs.select(docs[id_col].alias("_id"), docs[text_col].alias("_text"))
    phrases, templates = phrases or PHRASES, templates or TEMPLATES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(phrases, templates)
        for batch in slices(batches, "_text"):
            out: list[list] = [[] for _ in range(8)]
            for text in raw_texts(batch, "_text"):
                tokens = words(text)
                places, matches = automaton.scan(tokens)
                spans = automaton.spans(matches)
                base = {automaton.phrases[p][0] for _, p in places}
                starts = [s for s, _ in places]
                for column, value in zip(
                    out,
                    (
                        len(tokens), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
                        ",".join(sorted(base | {s[0] for s in spans})), 1.0 if base else float(max((s[3] for s in spans), default=0)),
                        [dict(zip(("label", "first_word", "last_word", "covered"), s, strict=True)) for s in spans],
                    ),
                    strict=True,
                ):
                    column.append(value)
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), SPAN_TYPE]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), *(pa.array(c, k) for c, k in zip(out, kinds, strict=True))],
                ["_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"],
            )

    ddl = f"n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<{SPAN}>"
    return rows.mapInArrow(run, with_fields(rows.schema["_id"], ddl)).withColumnRenamed("_id", id_col)
