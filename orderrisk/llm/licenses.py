"""License scan: winnowed fingerprints of templates find candidates, a banded alignment measures them.

The fingerprints of all templates form an inverted index (hash: template, place). A document's word runs
that are in the index vote for a template and a diagonal; votes on neighbouring diagonals are one
candidate. The words of the template and of the document are then aligned within a band around it.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .words import PLAIN, grams, mixed, slices, word_places, words

GRAM = 3
WINDOW = 2
BAND = 12
COVERAGE = 0.8

# Notices of well-known public licenses under their SPDX names.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer.",
    ),
    (
        "GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)


class Index:
    """The templates' words and the places of their fingerprints by hash."""

    def __init__(self, templates: tuple[tuple[str, str], ...], gram: int = GRAM, window: int = WINDOW) -> None:
        self.names = [name for name, _ in templates]
        hashes, ends = words(pa.array([text for _, text in templates], pa.string()), PLAIN)
        self.words = [hashes[a:b] for a, b in zip(ends, ends[1:], strict=False)]
        self.gram = gram
        entries: list[tuple[int, int, int]] = []
        for t, own in enumerate(self.words):
            runs, fits = grams(own, np.array([0, len(own)]), gram)
            runs = runs[fits]
            last = max(1, len(runs) - window + 1) if len(runs) else 0
            picked = {at + int(np.argmin(runs[at : at + window])) for at in range(last)}
            entries += [(int(runs[at]), t, at) for at in picked]
        entries.sort()
        self.hashes = np.array([e[0] for e in entries], np.uint64)
        self.template = np.array([e[1] for e in entries], np.int64)
        self.place = np.array([e[2] for e in entries], np.int64)
        self._head = np.zeros(1 << 16, bool)
        self._head[(self.hashes >> np.uint64(48)).astype(int)] = True

    def hits(self, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``runs``, index entry) of all fingerprints found."""
        maybe = np.flatnonzero(self._head[(runs >> np.uint64(48)).astype(np.int64)])
        low, high = (np.searchsorted(self.hashes, runs[maybe], side) for side in ("left", "right"))
        n = high - low
        at = np.repeat(maybe, n)
        return at, np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())


def align(template: np.ndarray, texts: np.ndarray, band: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Longest common subsequence within a band, for many stretches of text at once.

    ``texts[i, band + p]`` is the word that faces word p of the template if nothing is inserted or left out;
    each row has ``len(template) + 2 * band`` words, 0 where there is none. Returns the number of aligned
    words and the first and last + 1 aligned places of each row; of equal alignments the shortest.
    """
    width = 2 * band + 1
    shift = 20
    state = np.zeros((len(texts), width), np.int64)
    best, end = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    rows = np.arange(len(texts))
    for p, word in enumerate(template):
        facing = np.arange(p, p + width)
        equal = texts[:, facing] == word
        fresh = np.where(state >> shift == 0, facing, state)
        step = np.where(equal, fresh + (1 << shift), 0)
        # Leaving out a word of the template keeps the place in the text, which is one further in the band.
        kept = np.concatenate((state[:, 1:], np.zeros((len(texts), 1), np.int64)), axis=1)
        state = np.maximum.accumulate(np.maximum(step, kept), axis=1)
        top = state[:, -1] >> shift
        where = np.argmax(state >> shift == top[:, None], axis=1)
        better = top > best >> shift
        best = np.where(better, state[rows, where], best)
        end = np.where(better, where + p + 1, end)
    return best >> shift, np.where(best > 0, best & (1 << shift) - 1, 0), end


def _candidates(doc: np.ndarray, start: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Votes within ``reach`` of a candidate's first one belong to it."""
    pairs = np.unique(np.stack((doc, start)), axis=1).T.tolist()
    kept: list[list[int]] = []
    for one in pairs:
        if not kept or one[0] != kept[-1][0] or one[1] > kept[-1][1] + reach:
            kept.append(one)
    doc, start = np.array(kept, np.int64).reshape(-1, 2).T
    return doc, start


def _apart(found: list[tuple[int, ...]], size: list[int]) -> list[tuple[int, ...]]:
    """Of finds (document, template, aligned words, start, end) that overlap the one with the most aligned words."""
    found = sorted(found, key=lambda f: (f[0], -f[2], size[f[1]], f[3], f[1]))
    kept: list[tuple[int, ...]] = []
    spans: list[tuple[int, int]] = []
    for at, one in enumerate(found):
        if at and found[at - 1][0] != one[0]:
            spans = []
        place = bisect.bisect(spans, (one[3], one[4]))
        before = place and spans[place - 1][1] > one[3]
        if not before and not (place < len(spans) and spans[place][0] < one[4]):
            spans.insert(place, (one[3], one[4]))
            kept.append(one)
    return kept


def scan(
    docs: DataFrame,
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    coverage: float = COVERAGE,
    band: int = BAND,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per notice found: ``key``, license, template, coverage, n_words, start_word, end_word, start_byte, end_byte.

    coverage is the share of the template's words (n_words of them) that are aligned in order, at least
    ``coverage``; spans are places in the whole UTF-8 text. Of finds that overlap the one with the most aligned
    words counts, of equal ones that of the shorter template, then the first. A notice that shares ``GRAM + WINDOW - 1`` words in a row with its template is
    always tried. Null and empty texts have no finds, repeated rows have theirs each, an empty table gives no
    rows. ``templates`` is a short list and part of the code, not a table; templates under ``GRAM`` words find nothing.
    """
    index = Index(templates)
    names = ["license", "template", "coverage", "n_words", "start_word", "end_word", "start_byte", "end_byte"]

    def find(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(parts, 1):
            hashes, first, last, bytes_end = word_places(part.column(1), PLAIN)
            ends = np.searchsorted(first, bytes_end)
            runs, fits = grams(hashes, ends, index.gram)
            at, entry = index.hits(np.where(fits, runs, mixed(np.zeros(1, np.uint64))[0]))
            owner = np.searchsorted(ends, at, "right") - 1
            template, begin = index.template[entry], at - index.place[entry]
            found: list[tuple[int, ...]] = []
            for t in np.unique(template):
                mine = template == t
                doc, start = owner[mine], begin[mine]
                own = index.words[t]
                # So narrow that no second whole notice fits beside the one in the middle.
                reach = min(band, len(own) // 3)
                doc, start = _candidates(doc, start, reach)
                for some in range(0, len(doc), 4096):
                    d, s = doc[some : some + 4096], start[some : some + 4096]
                    places = s[:, None] + np.arange(-reach, len(own) + reach)
                    inside = (places >= ends[d][:, None]) & (places < ends[d + 1][:, None])
                    facing = np.where(inside, hashes[np.clip(places, 0, max(len(hashes) - 1, 0))], np.uint64(0))
                    n, a, b = align(own, facing, reach)
                    good = n >= coverage * len(own)
                    rows = zip(d[good], n[good], (s - reach + a)[good], (s - reach + b)[good], strict=True)
                    found += [(int(w), int(t), int(x), int(y), int(z)) for w, x, y, z in rows]
            kept = _apart(found, [len(w) for w in index.words])
            d, t, n, a, b = (np.array(x, np.int64) for x in (zip(*kept, strict=True) if kept else ([], [], [], [], [])))
            size = np.array([len(w) for w in index.words], np.int64)[t]
            columns = [
                pa.array([index.names[i] for i in t], pa.string()),
                pa.array(t, pa.int32()),
                pa.array(n / np.maximum(size, 1)),
                pa.array(size),
                pa.array(a - ends[d]),
                pa.array(b - ends[d]),
                pa.array(first[a] - bytes_end[d]),
                pa.array(last[b - 1] - bytes_end[d]),
            ]
            yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(d)), *columns], [key, *names])

    kind = docs.schema[key].dataType.simpleString()
    schema = "license string, template int, coverage double, n_words long, start_word long, end_word long, start_byte long, end_byte long"
    return docs.select(key, text).mapInArrow(find, f"`{key}` {kind}, {schema}")
