"""Licence scans by winnowed fingerprints and banded alignment.

Templates (licence notices) are fingerprinted by winnowing hashes of word
k-grams; an inverted index maps each fingerprint to the places in templates.
A text's own winnowed fingerprints look up candidates (template, diagonal);
each candidate's stretch of the text is aligned with the template inside a
band around the diagonal, unless its words lie in a place already found, and
reported with the matched share of the template and the span in the text.

The index holds the templates only, so its size has a bound that does not
grow with the data. Texts are independent: no shuffle.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm import textvec
from tidecast.llm.common import chunks, map_arrow

#: Words of a fingerprinted k-gram; k-grams of a winnowing window. A common
#: run of KGRAM + WINDOW - 1 words always shares a fingerprint.
KGRAM, WINDOW = 3, 3
#: Half width of the alignment band, in words; least matched share reported.
BAND = 8
MIN_COVERAGE = 0.8

_BSD_2 = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are "
    "met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution. ")
_BSD_3 = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
    "software without specific prior written permission. ")
_BSD_WARRANTY = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT "
    "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT "
    "HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT "
    "LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY "
    "THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF "
    "THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_MIT_WARRANTY = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY "
    "CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
    "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")

#: Notices by licence identifier. Bodies of the long licences
#: (Apache, GPL family, MPL, EPL, Creative Commons) are not among them.
TEMPLATES = {
    "AGPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
        "either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    "BSD-clauses": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
        "are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    "BSD-2-Clause-text": _BSD_2 + _BSD_WARRANTY,
    "BSD-3-Clause-text": _BSD_2 + _BSD_3 + _BSD_WARRANTY,
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0": (
        "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to "
        "the public domain worldwide. This software is distributed without any warranty."),
    "EPL-2.0": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at "
        "https://www.eclipse.org/legal/epl-2.0/"),
    "GPL-2.0-header": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    "ISC-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
        "the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS "
        "ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR "
        "BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR "
        "PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
        "PERFORMANCE OF THIS SOFTWARE."),
    "LGPL-2.1-header": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    "LGPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    "MIT": "Released under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
        "file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    "Unlicense-text": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or "
        "distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any "
        "means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in "
        "the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and "
        "successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this "
        "software under copyright law."),
}
TEMPLATES["MIT-full-text"] = TEMPLATES["MIT-text"] + " " + _MIT_WARRANTY

#: Bytes of words: letters and digits in lower case, other ASCII is blank,
#: bytes beyond ASCII stay.
_PLAIN = bytes(x if x >= 128 else ord(chr(x).lower()) if chr(x).isalnum() else 32 for x in range(256))


def plain(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").translate(_PLAIN)


def winnow(grams: np.ndarray, window: int) -> np.ndarray:
    """Positions of the winnowed fingerprints: the rightmost minimum of every
    window of consecutive hashes (of all hashes, if there are fewer)."""
    n = len(grams)
    if not n:
        return np.zeros(0, dtype=np.int64)
    window = min(window, n)
    low, at = grams[: n - window + 1].copy(), np.arange(n - window + 1)
    for j in range(1, window):
        nxt = grams[j:j + len(low)]
        less = nxt <= low
        low[less] = nxt[less]
        at[less] = np.flatnonzero(less) + j
    return np.unique(at)


class TemplateIndex:
    """Inverted index from fingerprint to (template, position)."""

    def __init__(self, templates: dict[str, str], kgram: int = KGRAM, window: int = WINDOW):
        self.kgram, self.window = kgram, window
        self.names = sorted(templates)
        self.words: list[np.ndarray] = []
        self.places: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for t, name in enumerate(self.names):
            hashes = textvec.words([plain(templates[name])]).hashes
            if len(hashes) < kgram + window - 1:
                raise ValueError(f"template {name} needs {kgram + window - 1} words at least")
            self.words.append(hashes)
            grams = textvec.windows(hashes, kgram)
            for p in range(len(grams)):  # all places: a text may winnow others near its own edges
                self.places[int(grams[p])].append((t, p))
        self.keys = np.array(sorted(self.places), dtype=np.uint64)
        used = {int(h) for words in self.words for h in words}
        self.blank = next(v for v in range(len(used) + 1) if v not in used)  # a hash that no template word has


def align(template: np.ndarray, text: np.ndarray, shift: int, band: int) -> tuple[int, int, int]:
    """Banded local alignment of all template words with text words around
    ``text position = template position + shift``: match 1, mismatch and gap
    -1, free ends in the text. Returns matched words of the best alignment and
    its first and end word in the text (0, 0, 0 without a match)."""
    width = 2 * band + 1
    score = np.zeros(width, dtype=np.int64)
    hits = np.zeros(width, dtype=np.int64)
    first = np.full(width, -1, dtype=np.int64)
    best = (0, 0, 0, 0)
    for i, word in enumerate(template):
        new = [0] * width
        new_hits, new_first = [0] * width, [-1] * width
        for d in range(width):
            j = i + shift + d - band
            options = [(0, 0, -1)]
            if 0 <= j < len(text):
                equal = text[j] == word
                diagonal = (score[d] + (1 if equal else -1), hits[d] + equal, j if first[d] < 0 and equal else first[d])
                options.append(diagonal)
            if d + 1 < width:
                options.append((score[d + 1] - 1, hits[d + 1], first[d + 1]))
            if d:
                options.append((new[d - 1] - 1, new_hits[d - 1], new_first[d - 1]))
            new[d], new_hits[d], new_first[d] = max(options, key=lambda o: (o[0], o[1]))
            if 0 <= j < len(text) and text[j] == word and (new_hits[d], new[d]) > best[:2]:
                best = (int(new_hits[d]), int(new[d]), int(new_first[d]), j + 1)
        score, hits, first = np.array(new), np.array(new_hits), np.array(new_first)
    return best[0], best[2], best[3]


def occurrences(index: TemplateIndex, t: int, words: np.ndarray, seeds: list[tuple[int, int]], band: int, min_coverage: float) -> list[tuple[int, int, int]]:
    """First and end word and matched words of the places, apart from each
    other, where template ``t`` is matched. ``seeds`` are (word, diagonal) of
    the k-grams shared. Words of a place found are blanked, so a seed outside
    is aligned with what is left, also where its band holds that place."""
    template = index.words[t]
    least = min_coverage * len(template)
    free, taken = words.copy(), np.zeros(len(words), dtype=bool)
    failed: set[int] = set()
    out = []

    def attempt(shift: int) -> tuple[int, int, int]:
        if shift in failed:
            return 0, 0, 0
        near = free[max(0, shift - band):max(0, shift + len(template) + band)]
        got = align(template, free, shift, band) if np.isin(template, near).sum() >= least else (0, 0, 0)
        if got[0] < least:  # nor will it match with more words blanked
            failed.add(shift)
            return 0, 0, 0
        return got

    for p, shift in seeds:
        while not taken[p:p + index.kgram].all():
            best = attempt(shift)
            if not best[0]:
                break
            if best[0] < len(template):  # another seed's band may hold more of this place
                for other in sorted({s for w, s in seeds if best[1] <= w < best[2] and s != shift}):
                    got = attempt(other)
                    if got[0] > best[0] and got[1] < best[2] and best[1] < got[2]:
                        best = got
            matched, first, end = best
            out.append((first, end, matched))
            free[first:end] = index.blank
            taken[first:end] = True
    return out


def without_look_alikes(found: list[tuple[int, int, int, int]], sizes: list[int]) -> list[tuple[int, int, int, int]]:
    """``found`` (first, end, template, matched) without inexact matches
    whose place another template matches better: more words of it or a larger
    share of the template, and not less of the other."""
    found = sorted(found)
    longest = max((f[1] - f[0] for f in found), default=0)
    out, low = [], 0
    for first, end, t, matched in found:
        while found[low][0] <= first - longest:
            low += 1
        better = False
        if matched < max(end - first, sizes[t]):
            for a, b, u, m in found[low:]:
                if a >= end:
                    break
                shared = min(b, end) - max(a, first)
                more, share = m - matched, m * sizes[t] - matched * sizes[u]
                better |= more >= 0 and share >= 0 and more + share > 0 and 2 * shared > end - first
        if not better:
            out.append((first, end, t, matched))
    return out


def scan_texts(texts: list[str | None], index: TemplateIndex, band: int = BAND, min_coverage: float = MIN_COVERAGE) -> Iterator[tuple[int, str, float, int, int, int]]:
    """(text, template, coverage, matched words, first and end character) of
    every place where a template is matched, by text and place; of licences
    with much the same notice, the one that matches best."""
    data = [plain(t) for t in texts]
    sizes = [len(words) for words in index.words]
    for a, b in chunks([len(t) for t in data], 1 << 20):
        w = textvec.words(data[a:b])
        grams = textvec.windows(w.hashes, index.kgram)
        if not len(grams):
            continue
        doc = np.repeat(np.arange(b - a), np.diff(w.offsets))
        inside = np.flatnonzero(doc[: len(grams)] == doc[index.kgram - 1:])
        cuts = np.searchsorted(doc[inside], np.arange(b - a + 1))
        near = np.minimum(np.searchsorted(index.keys, grams), len(index.keys) - 1)
        known = index.keys[near] == grams
        for d in np.unique(doc[inside[known[inside]]]):
            own = grams[inside[cuts[d]:cuts[d + 1]]]
            at = winnow(own, index.window)
            begin = w.offsets[d]
            words = w.hashes[begin:w.offsets[d + 1]]
            seeds = defaultdict(set)
            for p in at:
                for t, q in index.places.get(int(own[p]), ()):
                    seeds[t].add((int(p), int(p) - q))
            found = [(first, end, t, matched) for t in seeds for first, end, matched in occurrences(index, t, words, sorted(seeds[t]), band, min_coverage)]
            raw = data[a + d]
            for first, end, t, matched in without_look_alikes(found, sizes):
                lo, hi = int(w.starts[begin + first] - w.base[d]), int(w.ends[begin + end - 1] - w.base[d])
                lo, hi = len(raw[:lo].decode("utf-8", "surrogatepass")), len(raw[:hi].decode("utf-8", "surrogatepass"))
                yield a + int(d), index.names[t], matched / len(index.words[t]), matched, lo, hi


def license_matches(docs: DataFrame, templates: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text",
                    band: int = BAND, min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """One row for each match: doc_id, license, coverage (matched share of the
    template's words), n_matched, first_char, end_char (span in the text).

    Null and empty texts, and texts without a match, give no row; repeated
    rows and null ids give theirs. Other columns are ignored."""
    chosen = TEMPLATES if templates is None else templates
    schema = "doc_id bigint, license string, coverage double, n_matched int, first_char bigint, end_char bigint"
    types = [pa.int64(), pa.string(), pa.float64(), pa.int32(), pa.int64(), pa.int64()]
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = batch.column(0).to_pylist()
        rows = [(ids[r[0]], *r[1:]) for r in scan_texts(batch.column(1).to_pylist(), TemplateIndex(chosen), band, min_coverage)]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * len(types), types)], names)

    return map_arrow(docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")), run, schema)
