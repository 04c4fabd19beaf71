"""License notices in documents: MinHash bands over overlapping word windows.

A text's words (letters and digits, lower-cased) give a sequence of five-word
shingles, which is cut into windows of 4, 8, 16, ... shingles, each half
overlapping the next. A template of ``m`` shingles is sought in windows of the
smallest size that is ``2 * m`` or more, so one window always holds the whole
notice, and its similarity to 80 % of the template is above 0.19 there (1/4
for one shingle). Each of ``BANDS`` bands is one minimum, so such a window
misses every band with a probability below ``(1 - 0.19)**48 = 5e-5``.
Candidates are verified by the exact share of the template's distinct shingles
in a run of the window that holds no shingle more often than the template does,
so notices that follow each other are found one by one. Runs that begin and end
in the template's order and are no longer than it come first; then longer ones
(words were put in), then those in another order (parts were moved) count where
none of the former of the same template is. Where notices overlap, the best match stands: more shared
shingles (repeats count), then the smaller template, of which that is more.

Defined cases: a null or empty text matches nothing; a text of fewer words than
a shingle has its whole word sequence as one; repeated rows match each; a null
id is kept. Other columns are ignored.
"""

from __future__ import annotations

import bisect

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from brightlake.llm.text import Chunk, chunks, mix64

SHINGLE_WORDS = 5
BANDS = 48
PERCENT = 80
SMALLEST = 4

def _gnu(license_: str, version: str, work: str = "program", mark: str = ":") -> str:
    """The notice that the GNU licenses ask for in each file."""
    stop = ";" if mark == ";" else ","
    return (
        f"This {work} is free software{mark} you can redistribute it and/or modify it under the terms "
        f"of the GNU {license_} as published by the Free Software Foundation{stop} either "
        f"version {version} of the License, or (at your option) any later version. This {work} is "
        "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even "
        "the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
        f"{license_} for more details.")


_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are "
    "permitted provided that the following conditions are met: 1. Redistributions of source "
    "code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other "
    "materials provided with the distribution. ")
_BSD_NAMES = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to "
    "endorse or promote products derived from this software without specific prior written "
    "permission. ")
_BSD_DISCLAIMER = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS "
    "OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF "
    "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
    "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, "
    "EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
    "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND "
    "ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
    "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED "
    "OF THE POSSIBILITY OF SUCH DAMAGE.")
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
    "software and associated documentation files (the \"Software\"), to deal in the Software "
    "without restriction, including without limitation the rights to use, copy, modify, "
    "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
    "permit persons to whom the Software is furnished to do so")

#: Notices by license. ``/line`` and ``/licensed`` are one-line notices, some of
#: them as the documents word them; ``/text`` is a whole license text beside its opening part.
TEMPLATES = {
    "Apache-2.0/line": "Licensed under the Apache License, Version 2.0.",
    "CC-BY-4.0/line": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0/line": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0/line": "Licensed under CC BY-SA 4.0.",
    "GPL-2.0/line": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0/line": "This work is licensed under the GNU General Public License, version 3.",
    "MIT/line": "Released under the MIT License.",
    "MIT/licensed": "Licensed under the MIT License.",
    "BSD-2-Clause/line": "Licensed under the BSD 2-Clause License.",
    "BSD-3-Clause/line": "Licensed under the BSD 3-Clause License.",
    "MPL-2.0/line": "Licensed under the Mozilla Public License, version 2.0.",
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
        "file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed "
        "to in writing, software distributed under the License is distributed on an \"AS IS\" "
        "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    "BSD-2-Clause": _BSD + _BSD_DISCLAIMER,
    "BSD-3-Clause": _BSD + _BSD_NAMES + _BSD_DISCLAIMER,
    "GPL-2.0": _gnu("General Public License", "2", mark=";"),
    "GPL-3.0": _gnu("General Public License", "3"),
    "AGPL-3.0": _gnu("Affero General Public License", "3"),
    "LGPL-2.1": _gnu("Lesser General Public License", "2.1", "library", ";"),
    "LGPL-2.1/program": _gnu("Lesser General Public License", "2.1", "program", ";"),
    "LGPL-3.0": _gnu("Lesser General Public License", "3"),
    "LGPL-3.0/library": _gnu("Lesser General Public License", "3", "library"),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a "
        "copy of the MPL was not distributed with this file, You can obtain one at "
        "https://mozilla.org/MPL/2.0/."),
    "CC0-1.0": (
        "To the extent possible under law, the author(s) have dedicated all copyright and related "
        "and neighboring rights to this software to the public domain worldwide. This software is "
        "distributed without any warranty. You should have received a copy of the CC0 Public Domain "
        "Dedication along with this software."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR "
        "DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF "
        "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
        "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF "
        "USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS "
        "ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to "
        "copy, modify, publish, use, compile, sell, or distribute this software, either in source "
        "code form or as a compiled binary, for any purpose, commercial or non-commercial, and by "
        "any means. In jurisdictions that recognize copyright laws, the author or authors of this "
        "software dedicate any and all copyright interest in the software to the public domain. We "
        "make this dedication for the benefit of the public at large and to the detriment of our "
        "heirs and successors. We intend this dedication to be an overt act of relinquishment in "
        "perpetuity of all present and future rights to this software under copyright law."),
    "MIT": _MIT + ".",
    "MIT/text": (
        _MIT + ", subject to the following conditions: The above copyright notice and this "
        "permission notice shall be included in all copies or substantial portions of the Software. "
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, "
        "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
        "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE "
        "FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE."),
}

_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[65:91] += 32
_PLAIN[[b for b in range(128) if not chr(b).isalnum()]] = 32

_rng = np.random.default_rng(5)
_XOR = _rng.integers(0, 2**63, BANDS, dtype=np.uint64)
_ODD = _rng.integers(0, 2**63, BANDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _permuted(values: np.ndarray, i: int) -> np.ndarray:
    out = (values ^ _XOR[i]) * _ODD[i]
    return out ^ (out >> np.uint64(32))


def sequence(chunk: Chunk, k: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first word (of its row) and hash of every shingle, in text order."""
    plain = Chunk(_PLAIN[chunk.data], chunk.offsets)
    hashes, rows, counts = plain.word_hashes(), plain.words()[2], plain.word_counts()
    end = np.cumsum(counts)
    place = np.arange(len(rows)) - (end - counts)[rows]
    left = end[rows] - np.arange(len(rows))
    value = np.zeros(len(rows), dtype=np.uint64)
    for j in range(k):
        inside = np.flatnonzero(left > j)
        value[inside] = mix64(value[inside] * np.uint64(0x9E3779B97F4A7C15) + hashes[inside + j])
    pick = left >= np.minimum(counts, k)[rows]
    return rows[pick], place[pick], value[pick]


class Templates:
    """Shingle sets, window sizes and minima of the templates."""

    def __init__(self, texts: dict[str, str]):
        self.names = list(texts)
        data = pa.array(list(texts.values()), pa.string())
        sets: list[np.ndarray] = [np.zeros(0, np.uint64)] * len(texts)
        #: How often each shingle of the set stands in the template, and where first.
        self.shape: list[tuple[list[int], list[int]]] = [([], [])] * len(texts)
        for first, _, chunk in chunks(data):
            rows, _, values = sequence(chunk)
            for r in range(chunk.n):
                own = values[rows == r]
                sets[first + r], begin, times = np.unique(own, return_index=True,
                                                          return_counts=True)
                self.shape[first + r] = (times.tolist(), begin.tolist())
        self.sets = sets
        self.size = [max(SMALLEST, 1 << int(2 * len(s) - 1).bit_length()) if len(s) else 0
                     for s in sets]
        self.minima = np.array([[_permuted(s, i).min() if len(s) else 0 for i in range(BANDS)]
                                for s in sets], dtype=np.uint64).reshape(len(sets), BANDS)


def _candidates(rows: np.ndarray, values: np.ndarray, templates: Templates):
    """``(first shingle, end shingle, template)`` of windows that share a band."""
    if not len(rows):
        return
    row_start = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
    row_end = np.r_[row_start[1:], len(rows)]
    half = SMALLEST // 2

    def grid(begin, end, step):
        n = -(-(end - begin) // step)
        owner = np.repeat(np.arange(len(begin)), n)
        return begin[owner] + (np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)) * step, owner

    starts, owner = grid(row_start, row_end, half)
    minima = [np.minimum.reduceat(_permuted(values, i), starts) for i in range(BANDS)]
    largest = max(templates.size)
    while 2 * half <= largest:
        joined = np.r_[owner[1:] == owner[:-1], False]
        sought = [t for t, size in enumerate(templates.size) if size == 2 * half]
        hit = np.zeros((len(sought), len(starts)), dtype=bool)
        for i in range(BANDS if sought else 0):
            window = minima[i].copy()
            window[:-1][joined[:-1]] = np.minimum(window[:-1], minima[i][1:])[joined[:-1]]
            for k, t in enumerate(sought):
                hit[k] |= window == templates.minima[t, i]
        for k, t in enumerate(sought):
            for w in np.flatnonzero(hit[k]):
                yield starts[w], min(starts[w] + 2 * half, row_end[owner[w]]), t
        # Blocks of twice the size, from the first block of each row.
        first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        pairs, owner_new = grid(first, np.r_[first[1:], len(starts)], 2)
        minima = [np.minimum.reduceat(m, pairs) for m in minima]
        starts, owner, half = starts[pairs], owner_new, 2 * half


def _runs(codes: list[int], at: list[int], template: tuple, need: int, limit: int):
    """``(in order, hits, first, last, distinct)`` of runs with enough distinct shingles.

    A run is no longer than ``limit`` and holds no shingle more often than the template; of
    the runs from one start, the longest that ends in order stands, and the longest other.
    """
    times, offset = template
    # The places in the template of the last and the next hit that stands there once.
    before, after = [-1] * len(codes), [len(times)] * len(codes)
    for ends, step, order in ((before, -1, range(len(codes))),
                              (after, 1, range(len(codes) - 1, -1, -1))):
        for i in order:
            if times[codes[i]] == 1:
                ends[i] = offset[codes[i]]
            elif 0 <= i + step < len(codes):
                ends[i] = ends[i + step]
    held, shared, start = [0] * len(times), 0, 0
    found: dict[tuple[bool, int], tuple[bool, int, int, int, int]] = {}
    for n, (place, code) in enumerate(zip(at, codes), 1):
        held[code] += 1
        shared += held[code] == 1
        while held[code] > times[code] or place - at[start] >= limit:
            held[codes[start]] -= 1
            shared -= held[codes[start]] == 0
            start += 1
        if shared >= need:
            ordered = bool(after[start] <= before[n - 1])
            found[ordered, start] = (ordered, n - start, at[start], place, shared)
    return found.values()


def matches(chunk: Chunk, templates: Templates, percent: int = PERCENT):
    """``(row, template, first word, shared, size)`` of every notice, the best at each place."""
    rows, place, values = sequence(chunk)
    # By row: runs in order and no longer than the template, other runs in order, the rest.
    found: dict[int, list[set[tuple[int, int, int, int, int]]]] = {}
    for a, b, t in _candidates(rows, values, templates):
        inside = np.flatnonzero(np.isin(values[a:b], templates.sets[t]))
        size = len(templates.sets[t])
        need = -(-percent * size // 100)
        if len(inside) < need:
            continue
        codes = np.searchsorted(templates.sets[t], values[a:b][inside]).tolist()
        if len(set(codes)) < need:
            continue
        at, classes = place[a + inside].tolist(), found.setdefault(int(rows[a]), [set(), set(), set()])
        length = sum(templates.shape[t][0])
        for limit in (length, int(b - a)):
            for ordered, *run in _runs(codes, at, templates.shape[t], need, limit):
                classes[(limit > length) if ordered else 2].add((*run, t))
    for row, classes in sorted(found.items()):
        hits: set[tuple[int, int, int, int, int]] = set()
        for more in classes:
            spans: dict[int, list[tuple[int, int]]] = {}
            for _, begin, end, _, t in hits:
                spans.setdefault(t, []).append((begin, end))
            # Starts in order, and the furthest end up to each.
            reach = {t: ([p[0] for p in sorted(pairs)],
                         np.maximum.accumulate([p[1] for p in sorted(pairs)]))
                     for t, pairs in spans.items()}
            for hit in more:
                starts, ends = reach.get(hit[4], ((), ()))
                at = bisect.bisect(starts, hit[2])
                if not at or ends[at - 1] < hit[1]:
                    hits.add(hit)
        # Kept notices do not overlap, so they stand in one order.
        begins: list[int] = []
        kept: list[tuple[int, int, int, int]] = []
        for _, begin, end, shared, t in sorted(hits, key=lambda h: (
                -h[0], sum(templates.shape[h[4]][0]), h[2] - h[1], h[1], h[4])):
            at = bisect.bisect(begins, end)
            if at and kept[at - 1][1] >= begin:
                continue
            begins.insert(at, begin)
            kept.insert(at, (begin, end, t, shared))
        for begin, _, t, shared in kept:
            yield row, t, begin, shared, len(templates.sets[t])


def scan(docs: DataFrame, templates: dict[str, str] | None = None, key: str = "doc_id",
         text: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row for each notice found: ``key``, ``license``, ``first_word``, ``n_shared``,
    ``n_template`` (distinct shingles) and ``containment``."""
    known = Templates(TEMPLATES if templates is None else templates)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for first, _, chunk in chunks(batch.column(1)):
                hits = list(matches(chunk, known, percent))
                if hits:
                    row, t, begin, shared, size = map(list, zip(*hits))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array([first + r for r in row])),
                         pa.array([known.names[i] for i in t], pa.string()),
                         pa.array(begin, pa.int64()), pa.array(shared, pa.int64()),
                         pa.array(size, pa.int64()),
                         pa.array([s / n for s, n in zip(shared, size)], pa.float64())],
                        [key, "license", "first_word", "n_shared", "n_template", "containment"])

    return docs.select(key, text).mapInArrow(
        run, f"`{key}` {kind}, license string, first_word long, n_shared long, n_template long, "
             "containment double")
