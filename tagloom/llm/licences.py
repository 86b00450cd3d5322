"""Licence scans: winnowed fingerprints of templates pick candidates, banded alignment reports coverage and spans.

The templates are a bounded table. Their winnowed word-trigram fingerprints form an inverted index that every task
holds. All trigrams of a text are looked up, so that any run of words a template and a text share beyond the winnowing
window is noticed. Hits of one template that lie on about the same diagonal are one candidate; around it, text and
template are aligned within a band.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tagloom.llm import base

#: Words of a fingerprint, fingerprints of which the smallest is kept, words the alignment may drift by, least matched share.
GRAM, WINNOW, BAND, COVERAGE = 3, 4, 8, 0.75
#: Most words of all templates, as every task holds them.
MOST_WORDS = 2_000_000
#: Licence texts and notices, by SPDX name.
TEMPLATES = {
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "Released under the MIT License.",
        "Licensed under the MIT License.",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "Licensed under the Apache License, Version 2.0.",
    ),
    "BSD-2-Clause": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED", "Licensed under the BSD 2-Clause License."),
    "GPL-2.0": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
        "This work is licensed under the GNU General Public License, version 2.",
    ),
    "AGPL-3.0": ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",),
    "CC0-1.0": ("To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide. This software is distributed without any warranty.",),
    "CC-BY-ND-4.0": ("This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.", "Licensed under CC BY-ND 4.0."),
    "Zlib": ("This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",),
    "BSL-1.0": ("Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt)",),
    "EPL-2.0": ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",),
    "BSD-3-Clause": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.", "Licensed under the BSD 3-Clause License."),
    "ISC": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",),
    "GPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This work is licensed under the GNU General Public License, version 3.",
    ),
    "LGPL-3.0": ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 3 of the License, or (at your option) any later version.",),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",),
    "CC-BY-4.0": ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "Licensed under CC BY 4.0."),
    "CC-BY-SA-4.0": ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "Licensed under CC BY-SA 4.0."),
    "CC-BY-NC-4.0": ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "Licensed under CC BY-NC 4.0."),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
    "proprietary": ("All rights reserved.",),
}
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def winnow(h: np.ndarray, window: int) -> np.ndarray:
    """Places of the smallest hash (the last such) of every `window` consecutive ones; of all of them, if there are fewer."""
    if not len(h):
        return np.zeros(0, int)
    window = min(window, len(h))
    view = np.lib.stride_tricks.sliding_window_view(h, window)[:, ::-1]
    return np.unique(np.arange(len(view)) + window - 1 - view.argmin(1))


def align(a: list[bytes], b: list[bytes], shift: int, band: int) -> tuple[int, int, int, int, int]:
    """Local alignment of template `a` and text `b` within `band` words of the diagonal j = i + shift.

    A match gives 2, a mismatch or gap takes 1. Returns matched words and the aligned ranges of a and b (end exclusive).
    """
    width = 2 * band + 1
    best, end = 0, (0, 0)
    before = [(0, 0, -1, -1)] * (width + 2)  # score, matches, start in a, start in b
    out = (0, 0, 0, 0, 0)
    for i, word in enumerate(a):
        now = [(0, 0, -1, -1)] * (width + 2)
        for k in range(1, width + 1):
            j = i + shift - band + k - 1
            if not 0 <= j < len(b):
                continue
            score, hits, si, sj = before[k]
            if word == b[j]:
                cell = (score + 2, hits + 1, si if si >= 0 else i, sj if sj >= 0 else j)
            else:
                cell = (score - 1, hits, si, sj)
            for near in (before[k + 1], now[k - 1]):  # a word left out of the text, or put in
                if near[0] - 1 > cell[0]:
                    cell = (near[0] - 1, *near[1:])
            if cell[0] > 0:
                now[k] = cell
                if cell[0] > best:
                    best, end = cell[0], (i, j)
                    out = (cell[1], cell[2], i + 1, cell[3], j + 1)
        before = now
    return out


class Index:
    """Templates, and where their fingerprints are."""

    def __init__(self, templates: dict[str, tuple[str, ...]]):
        self.texts: list[tuple[str, int, list[bytes]]] = []
        grams: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for name, versions in sorted(templates.items()):
            for k, text in enumerate(versions):
                at, raw = base.text_buffer(pa.array([text]))
                words = base.Words(at, raw, lower=True)
                n = min(GRAM, len(words.start))
                if not n:
                    continue
                h = base.mix(base.windows(words.hashes(), n) + np.uint64(n))
                data = words.raw.tobytes()
                for place in winnow(h, WINNOW):
                    grams[int(h[place])].append((len(self.texts), int(place)))
                self.texts.append((name, k, [data[s:e] for s, e in zip(words.start, words.end, strict=True)]))
        if sum(len(t[2]) for t in self.texts) > MOST_WORDS:
            raise ValueError("the templates are too large to be held by every task")
        self.hashes = np.array(sorted(grams), np.uint64)
        self.places = [grams[int(h)] for h in self.hashes]
        self.sizes = sorted({min(GRAM, len(t[2])) for t in self.texts})

    def scan(self, words: base.Words, data: bytes) -> Iterator[tuple[int, str, int, int, float, int, int]]:
        """(row, licence, version, matched, coverage, start word, end word) of each alignment that covers enough, best first within a row."""
        h = words.hashes()
        found: dict[tuple[int, int], list[int]] = defaultdict(list)
        for n in self.sizes:
            if len(h) < n:
                continue
            grams = base.mix(base.windows(h, n) + np.uint64(n))
            at = np.minimum(np.searchsorted(self.hashes, grams), len(self.hashes) - 1)
            for place in np.flatnonzero((self.hashes[at] == grams) & base.inside(words, n)).tolist():
                doc = int(words.doc[place])
                for text, offset in self.places[at[place]]:
                    found[doc, text].append(place - int(words.first[doc]) - offset)
        hits: dict[int, list[tuple]] = defaultdict(list)
        for (doc, text), shifts in sorted(found.items()):
            name, version, template = self.texts[text]
            first, last = int(words.first[doc]), int(words.first[doc + 1])
            shifts, k = sorted(set(shifts)), 0
            while k < len(shifts):  # hits on about the same diagonal
                j = k
                while j + 1 < len(shifts) and shifts[j + 1] - shifts[k] <= BAND:
                    j += 1
                shift = (shifts[k] + shifts[j]) // 2
                lo = max(first, first + shift - BAND)
                hi = min(last, first + shift + len(template) + BAND)
                body = [data[s:e] for s, e in zip(words.start[lo:hi].tolist(), words.end[lo:hi].tolist(), strict=True)]
                matched, _, _, b0, b1 = align(template, body, shift - (lo - first), BAND)
                if matched / len(template) >= COVERAGE:
                    hits[doc].append((name, version, matched, matched / len(template), lo - first + b0, lo - first + b1))
                k = j + 1
        for doc in sorted(hits):
            taken: list[tuple[int, int]] = []
            for hit in sorted(hits[doc], key=lambda x: (-x[2], -x[3], x[4], x[0], x[1])):
                if all(hit[5] <= a or hit[4] >= b for a, b in taken):  # of overlapping ones the one with most words
                    taken.append(hit[4:6])
                    yield (doc, *hit)


def scan(df: DataFrame, templates: dict[str, tuple[str, ...]] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Licences in each text: id_col, licence, version (of the template), matched (words), coverage, start, end.

    `coverage` is the share of the template's words that the alignment matches; alignments under COVERAGE are not
    reported. `start` and `end` are character offsets, end exclusive. Of overlapping alignments the one that matches
    most words stays (then: larger coverage, earlier, name). Case doesn't matter (A-Z). Texts without a licence, null
    and empty ones give no row; repeated rows and null ids give the rows that each would. No shuffle; texts are whole.
    """
    index = Index(TEMPLATES if templates is None else templates)
    shared, kind = df.sparkSession.sparkContext.broadcast(index), dict(df.select(id_col).dtypes)[id_col]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            at, raw = base.text_buffer(batch.column(1))
            for i, j in base.chunks(at):
                words = base.Words(at[i : j + 1], raw, lower=True)
                data = words.raw.tobytes()
                rows, spans = [], []
                for doc, *hit, a, b in index.scan(words, data) if len(index.hashes) else ():
                    begin = int(at[i + doc] - at[i])
                    first = int(words.first[doc])
                    s, e = int(words.start[first + a]), int(words.end[first + b - 1])
                    lead = len(data[begin:s].decode("utf-8"))
                    rows.append((i + doc, *hit))
                    spans.append((lead, lead + len(data[s:e].decode("utf-8"))))
                columns = list(zip(*rows, strict=True)) if rows else [()] * 5
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(columns[0], pa.int64())), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.int32()), pa.array(columns[3], pa.int32()), pa.array(columns[4], pa.float64()), pa.array([s for s, _ in spans], pa.int64()), pa.array([e for _, e in spans], pa.int64())], names=[id_col, "licence", "version", "matched", "coverage", "start", "end"])

    return df.select(F.col(id_col), F.col(text_col)).mapInArrow(work, f"`{id_col}` {kind}, licence string, version int, matched int, coverage double, start long, end long")
