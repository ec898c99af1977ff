"""License scans: MinHash bands over overlapping text windows retrieve templates, exact shingles verify them.

A template is retrieved through windows of a power of two shingles, at most half its own, that begin at each of its
shingles; a text's windows of that size begin at every quarter of a window. For a window that keeps a likeness s to a
template's window, all bands of `rows` minima miss with probability (1 - s**rows)**bands: 16 bands of 2 rows find
s = 0.6 with 99.9 %. Then every shingle around the window is compared with the template's.
"""

from __future__ import annotations

import re
from functools import partial

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgraph.llm.common import held

SHINGLE = 5
CONTAINED = 0.8
BANDS, ROWS = 16, 2
LARGEST_WINDOW = 16
REMEMBER = 300_000
#: Words hashed in one step; steps overlap by a window.
STEP = 1 << 15

#: Notices of public licenses, by SPDX identifier and form.
TEMPLATES: dict[str, str] = {
    "Apache-2.0/line": "Licensed under the Apache License, Version 2.0.",
    "CC-BY-NC-4.0/line": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0/line": "This work is licensed under the GNU General Public License, version 3.",
    "MIT/line": "Released under the MIT License.",
    "Apache-2.0/header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    "BSD-2-Clause/conditions": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "BSD-3-Clause/endorsement": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "BSD/disclaimer": 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.',
    "CC-BY-4.0/line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0/line": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0/waiver": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "GPL-2.0/header": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "GPL-3.0/header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "ISC/grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "LGPL-2.1/header": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.",
    "MIT/grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.',
    "MIT/warranty": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    "MPL-2.0/header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "Unlicense/dedication": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
}

_trim = re.compile(rb"^[^\w\x80-\xff]+|[^\w\x80-\xff]+$")


class WordHashes(dict):
    """A word's hash, case and outer punctuation aside; zero for bare punctuation, which is passed over."""

    def __missing__(self, word: bytes) -> int:
        bare = _trim.sub(b"", word).lower()
        h = xxhash.xxh3_64_intdigest(bare) | 1 if bare else 0
        if len(self) < REMEMBER:
            self[word] = h
        return h


def word_hashes(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words that are more than punctuation, and their places among all words."""
    w = (text or "").encode("utf-8", "surrogatepass").split()
    h = np.fromiter(map(held("licenses", WordHashes).__getitem__, w), np.uint64, len(w))
    at = np.flatnonzero(h)
    return h[at], at


def shingles(h: np.ndarray) -> np.ndarray:
    """Hashes of all runs of five words."""
    n = len(h) - SHINGLE + 1
    if n < 1:
        return np.empty(0, np.uint64)
    s = h[:n].copy()
    for k in range(1, SHINGLE):
        s = (s ^ (s >> np.uint64(31))) * np.uint64(0x9FB21C651E98DF25) + h[k : n + k]
    return (s ^ (s >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


_rng = np.random.default_rng(20)
_mul = _rng.integers(1, 1 << 62, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def minima(s: np.ndarray, row: int, largest: int) -> dict[int, np.ndarray]:
    """The row's minimum over the window of each size that begins at each shingle."""
    m = (s ^ (s >> np.uint64(32))) * _mul[row]
    m = (m >> np.uint64(32)).astype(np.uint32)
    out, size = {1: m}, 1
    while size < largest and len(m) > size:
        m = np.minimum(m[:-size], m[size:])
        size *= 2
        out[size] = m
    return out


def band_keys(s: np.ndarray, sizes: set[int], stride: dict[int, int]):
    """For each band and window size: the keys of the windows that begin at each stride."""
    largest = max(sizes)
    for band in range(BANDS):
        rows = [minima(s, band * ROWS + r, largest) for r in range(ROWS)]
        for size in sizes:
            # In windows of one shingle every band says the same.
            if size in rows[0] and (size > 1 or not band):
                step = stride[size]
                key = rows[0][size][::step].astype(np.uint64)
                for m in rows[1:]:
                    key = (key * np.uint64(0x9E3779B97F4A7C15)) ^ m[size][::step]
                yield band, size, (key ^ (key >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


class Templates:
    """The templates' shingles, and their bands by key with a small filter in front."""

    def __init__(self, texts: dict[str, str]):
        self.names = sorted(texts)
        self.sets, self.size, entries = [], [], {}
        for t, name in enumerate(self.names):
            s = shingles(word_hashes(texts[name])[0])
            if not len(s):
                raise ValueError(f"template {name} has fewer than {SHINGLE} words")
            self.sets.append(np.unique(s))
            self.size.append(len(s))
            window = 1
            while window * 2 <= min(LARGEST_WINDOW, max(1, len(s) // 2)):
                window *= 2
            for band, size, keys in band_keys(s, {window}, {window: 1}):
                for at, k in enumerate(keys.tolist()):
                    entries.setdefault((band, size), {}).setdefault(k, set()).add((t, at))
        self.tables = entries
        self.windows = {size for _, size in entries}
        self.stride = {w: max(1, w // 4) for w in self.windows}
        self.filters = {}
        for k, table in entries.items():
            f = np.zeros(1 << 16, bool)
            f[np.array(list(table), np.uint64) >> np.uint64(48)] = True
            self.filters[k] = f

    def candidates(self, s: np.ndarray) -> set[tuple[int, int]]:
        """Templates and the shingle at which each would begin."""
        out = set()
        for band, size, keys in band_keys(s, self.windows, self.stride):
            table = self.tables.get((band, size))
            if table:
                hit = np.flatnonzero(self.filters[band, size][keys >> np.uint64(48)])
                for at, k in zip((hit * self.stride[size]).tolist(), keys[hit].tolist()):
                    out.update((t, at - place) for t, place in table.get(k, ()))
        return out

    def scan(self, texts: list[str | None]) -> list[list[tuple[str, int, int, float]]]:
        """Matches of each text: template, first word, word after the last, and the share of its shingles found there.

        The texts' words lie end to end in one array, so that short texts cost no more than long ones; what reaches
        across the end of a text is no match, as only the text's own shingles are counted.
        """
        parts = [word_hashes(t) for t in texts]
        ends = np.cumsum([len(h) for h, _ in parts])
        h = np.concatenate([p[0] for p in parts]) if parts else np.empty(0, np.uint64)
        met = set()
        for begin in range(0, len(h), STEP):
            s = shingles(h[begin : begin + STEP + LARGEST_WINDOW + SHINGLE])
            if len(s):
                met.update((t, begin + at) for t, at in self.candidates(s))
        best: list[dict[tuple[int, int], tuple[float, int, int]]] = [{} for _ in texts]
        for t, at in sorted(met):
            n = self.size[t]
            slack = max(1, n // 4)
            # A template may reach over a text's border; it belongs to the text with its middle.
            d = int(np.searchsorted(ends, max(0, at + n // 2), side="right"))
            if d == len(texts):
                continue
            start = int(ends[d]) - len(parts[d][0])
            lo = max(start, at - slack)
            s = shingles(h[lo : max(lo, min(int(ends[d]), at + n + slack + SHINGLE - 1))])
            inside = np.isin(s, self.sets[t])
            share = len(np.unique(s[inside])) / len(self.sets[t])
            if share >= CONTAINED:
                where, place = np.flatnonzero(inside) + lo - start, parts[d][1]
                got = share, int(place[where[0]]), int(place[where[-1] + SHINGLE - 1]) + 1
                for k in [k for k in best[d] if k[0] == t and best[d][k][1] < got[2] and got[1] < best[d][k][2]]:
                    got = max(got, best[d].pop(k), key=lambda g: (g[0], g[1] - g[2], -g[1]))
                best[d][t, got[1]] = got
        return [sorted((self.names[t], a, b, share) for (t, _), (share, a, b) in m.items()) for m in best]


def _scan(batches, texts: dict[str, str]):
    t = Templates(texts)
    for p in batches:
        found = t.scan(p["text"].tolist())
        rows = [(i, *m) for i, own in zip(p["doc_id"].astype(object).where(p["doc_id"].notna(), None), found) for m in own]
        yield pd.DataFrame(rows, columns=["doc_id", "template", "start_word", "end_word", "contained"]).astype({"doc_id": "Int64"})


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Find license texts: ``doc_id``, ``template``, ``start_word``, ``end_word`` (half open) and ``contained``.

    A match holds at least 0.8 of the template's distinct five-word shingles within the template's length and a
    quarter of slack on both sides; of overlapping matches of one template the fullest stays. Case and outer
    punctuation don't count. Texts of two licenses can be so alike that both match (versions of one header): the higher
    ``contained`` tells them apart. Templates are a parameter (a few hundred texts), shipped with the task.

    Null, empty and short texts have no match and give no row; repeated rows and null ids are scanned like any
    other; an empty table gives no rows; other columns are ignored.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return base.mapInPandas(partial(_scan, texts=templates or TEMPLATES), "doc_id long, template string, start_word long, end_word long, contained double")


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))
