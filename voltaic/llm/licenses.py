"""License scans: winnowed fingerprints, then banded sequence alignment.

Texts and license templates become word sequences. Word k-grams are hashed
and winnowed: of every ``WINDOW`` hashes in a row the least is a fingerprint,
so any run of ``GRAM + WINDOW - 1`` words shared by text and template shares a
fingerprint. An inverted index of the templates' fingerprints proposes a
template and a diagonal (text word minus template word); an alignment of word
sequences within a band around the diagonal reports how much of the template
matched, and where.
"""

from __future__ import annotations

import re
import warnings
from dataclasses import dataclass
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from voltaic.llm.common import chunks

#: Parts that several templates share.
_BSD_TWO = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
    "are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution."
)
_BSD_THIRD = (
    " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from "
    "this software without specific prior written permission."
)
_BSD_DISCLAIMER = (
    ' THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT '
    "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT "
    "HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT "
    "LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON "
    "ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE "
    "USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_ISC_OPENING = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
    "the above copyright notice and this permission notice appear in all copies."
)
_ISC_DISCLAIMER = (
    ' THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF '
    "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY "
    "DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, "
    "ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_MIT_OPENING = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
    '"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, '
    "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to "
    "the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions "
    "of the Software."
)
_MIT_DISCLAIMER = (
    ' THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR "
    "ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH "
    "THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)


def _gnu(kind: str, version: str, thing: str = "program", mark: str = ":") -> str:
    """Header that the GNU licenses ask for."""
    own = f"GNU {kind}General Public License"
    return (
        f"This {thing} is free software{mark} you can redistribute it and/or modify it under the terms of the {own} as published by the Free "
        f"Software Foundation, either version {version} of the License, or (at your option) any later version. This {thing} is distributed in "
        "the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
        f"PARTICULAR PURPOSE. See the {own} for more details."
    )


#: Short notices, whole short licenses, their openings (without
#: the disclaimer), and the headers of long licenses (whose texts are read from
#: files, see ``LONG_TEXTS``).
TEMPLATES = {
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
        "either express or implied. See the License for the specific language governing permissions and limitations under the License."
    ),
    "AGPL-3.0 header": _gnu("Affero ", "3"),
    "BSD-2-Clause": _BSD_TWO + _BSD_DISCLAIMER,
    "BSD-2-Clause opening": _BSD_TWO,
    "BSD-3-Clause": _BSD_TWO + _BSD_THIRD + _BSD_DISCLAIMER,
    "BSD-3-Clause opening": _BSD_TWO + _BSD_THIRD,
    "CC-BY-4.0 notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0 notice": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0 notice": (
        "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to "
        "the public domain worldwide. This software is distributed without any warranty. You should have received a copy of the CC0 Public "
        "Domain Dedication along with this software. If not, see <http://creativecommons.org/publicdomain/zero/1.0/>."
    ),
    "GPL-2.0 header": _gnu("", "2", mark=";"),
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 header": _gnu("", "3"),
    "ISC": _ISC_OPENING + _ISC_DISCLAIMER,
    "ISC opening": _ISC_OPENING,
    "LGPL-2.1 header": _gnu("Lesser ", "2.1", "library", ";"),
    "LGPL-3.0 header": _gnu("Lesser ", "3"),
    "MIT notice": "Released under the MIT License.",
    "MIT": _MIT_OPENING + _MIT_DISCLAIMER,
    "MIT opening": _MIT_OPENING,
    "MPL-2.0 header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
        "file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or "
        "distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any "
        "means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in "
        "the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and "
        "successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this "
        "software under copyright law."
        + _MIT_DISCLAIMER.replace(" AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE", " AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE")
        + " For more information, please refer to <http://unlicense.org/>"
    ),
}
#: Whole long licenses, and their files in the folder of licenses that Debian
#: and its kin install.
LICENSE_DIR = "/usr/share/common-licenses"
LONG_TEXTS = {
    "Apache-2.0 text": "Apache-2.0",
    "Artistic-1.0 text": "Artistic",
    "CC0-1.0 text": "CC0-1.0",
    "GFDL-1.2 text": "GFDL-1.2",
    "GFDL-1.3 text": "GFDL-1.3",
    "GPL-1.0 text": "GPL-1",
    "GPL-2.0 text": "GPL-2",
    "GPL-3.0 text": "GPL-3",
    "LGPL-2.0 text": "LGPL-2",
    "LGPL-2.1 text": "LGPL-2.1",
    "LGPL-3.0 text": "LGPL-3",
    "MPL-1.1 text": "MPL-1.1",
    "MPL-2.0 text": "MPL-2.0",
}


def long_texts(folder: str = LICENSE_DIR) -> dict[str, str]:
    """Texts of ``LONG_TEXTS`` that ``folder`` on the driver's machine holds; a
    warning names the others, which are then not searched."""
    files = {name: Path(folder, file) for name, file in LONG_TEXTS.items()}
    absent = [name for name, file in files.items() if not file.is_file()]
    if absent:
        warnings.warn(f"licenses not searched, absent from {folder}: {', '.join(absent)}")
    return {name: file.read_text("utf-8", "replace") for name, file in files.items() if name not in absent}


#: Templates with much text in common, or that hold one another; of
#: overlapping matches only the best fit counts.
FAMILIES = {
    **{n: "Apache" for n in ("Apache-2.0 text", "Apache-2.0 header")},
    **{n: "BSD" for n in TEMPLATES if n.startswith("BSD")},
    **{n: "GNU" for n in TEMPLATES if n.endswith("GPL-3.0 header") or n in ("GPL-2.0 header", "LGPL-2.1 header")},
    **{n: "GNU" for n in LONG_TEXTS if n.startswith(("GFDL", "GPL", "LGPL"))},
    **{n: "MPL" for n in ("MPL-1.1 text", "MPL-2.0 text", "MPL-2.0 header")},
    **{n: "ISC" for n in ("ISC", "ISC opening")},
    **{n: "MIT" for n in ("MIT", "MIT opening", "Unlicense")},
}

GRAM = 3
WINDOW = 2
#: Least share of a template's words that a reported match covers.
MIN_COVERAGE = 0.7
#: Words of text that are hashed at one time; pieces overlap by twice the
#: longest template, so no match is cut.
PIECE = 1 << 18
#: Texts whose matches a task remembers for copies of them, and their length.
REMEMBERED = 256
REMEMBERED_CHARS = 1 << 16
MIX = np.uint64(0x9E3779B97F4A7C15)
_WORD = re.compile(r"[^\W_]+")


@dataclass(frozen=True)
class Match:
    template: int
    start: int
    end: int
    matched: int
    coverage: float


class Index:
    """Inverted index of winnowed fingerprints; as large as the templates."""

    def __init__(self, templates: dict[str, str], gram: int = GRAM, window: int = WINDOW, min_coverage: float = MIN_COVERAGE):
        self.names = list(templates)
        self.gram, self.window, self.min_coverage = gram, window, min_coverage
        self.vocabulary: dict[str, int] = {}
        self.words = [
            np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in _WORD.findall(t.lower())], np.int64) for t in templates.values()
        ]
        self.longest = max(map(len, self.words), default=0)
        found = [(h, k, at) for k, ids in enumerate(self.words) for h, at in zip(*self.fingerprints(ids))]
        found.sort()
        self.entries = np.bincount([k for _, k, _ in found], minlength=len(self.words))
        self.bags = [np.bincount(ids, minlength=len(self.vocabulary) + 1) for ids in self.words]
        self.keys = np.array([h for h, _, _ in found], np.uint64)
        self.template = np.array([k for _, k, _ in found], np.int64)
        self.at = np.array([at for _, _, at in found], np.int64)

    def fingerprints(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Winnowed hashes of word k-grams and their positions."""
        n = len(ids) - self.gram + 1
        if n < 1:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        h = np.zeros(n, np.uint64)
        for i in range(self.gram):
            h = h * MIX + ids[i : i + n].astype(np.uint64)
        h ^= h >> np.uint64(29)
        h *= MIX
        if n <= self.window:
            return h, np.arange(n)
        least = np.lib.stride_tricks.sliding_window_view(h, self.window).min(1)
        chosen = np.zeros(n, bool)
        for i in range(self.window):
            chosen[i : i + len(least)] |= h[i : i + len(least)] == least
        at = np.flatnonzero(chosen)
        return h[at], at

    def least(self, template: int) -> float:
        """Matched words that a reported match has at least."""
        return self.min_coverage * len(self.words[template])

    def diagonals(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (template, diagonal) of shared fingerprints, and how many.

        A template that needs more words than the text has known ones is left out.
        """
        h, at = self.fingerprints(ids)
        low, high = np.searchsorted(self.keys, h), np.searchsorted(self.keys, h, "right")
        times = high - low
        entry = np.arange(times.sum()) + np.repeat(low - np.cumsum(times) + times, times)
        known = np.count_nonzero(ids)
        fits = np.array([known >= self.least(k) for k in range(len(self.words))], bool)[self.template[entry]]
        entry, at = entry[fits], np.repeat(at, times)[fits]
        return np.unique(np.stack([self.template[entry], at - self.at[entry]], 1), axis=0, return_counts=True)

    def matches(self, ids: np.ndarray) -> set[tuple[int, int, int, int]]:
        """(template, first word, end word, matched words) of copies and alignments.

        Copies of whole templates need no alignment. Close diagonals of a
        template are one candidate. A candidate is left out only if no match
        of it can be reported: its band shares too few words with the
        template, in whatever order, or does so outside of copies of its
        family that fit better than any match of it.
        """
        pairs, votes = self.diagonals(ids)
        whole, merged = [], []
        for (k, d), n in zip(pairs.tolist(), votes.tolist()):
            m = len(self.words[k])
            if d >= 0 and 2 * n >= self.entries[k] and np.array_equal(ids[d : d + m], self.words[k]):
                whole.append((k, d, d + m, m))
            if not merged or merged[-1][0] != k or d - merged[-1][1] > self.slack(k) // 2:
                merged.append((k, d))
        found = set(whole)
        for k, d in merged:
            most = self.shared(ids, k, d)
            if most < self.least(k):
                continue
            better = [y for y in whole if y[0] == k or self.family(y[0]) == self.family(k) and y[3] > most]
            if better:
                rest = ids.copy()
                for _, a, b, _ in better:
                    rest[a:b] = 0
                if self.shared(rest, k, d) < self.least(k):
                    continue
            first, last, matched = self.align(ids, k, d)
            if matched >= self.least(k):
                found.add((k, first, last, matched))
        return found

    def family(self, template: int) -> str:
        return FAMILIES.get(self.names[template], self.names[template])

    def reach(self, template: int, diagonal: int) -> tuple[int, int]:
        """First and end word of the text that a candidate's band touches."""
        low = diagonal - self.slack(template)
        return max(0, low), low + len(self.words[template]) + 2 * self.slack(template) + 1

    def shared(self, ids: np.ndarray, template: int, diagonal: int) -> int:
        """Words of the template in the band's stretch of text, repeats
        counted: no alignment there matches more."""
        a, b = self.reach(template, diagonal)
        bag = np.bincount(ids[a : max(a, b)], minlength=len(self.vocabulary) + 1)
        return int(np.minimum(bag, self.bags[template])[1:].sum())

    def slack(self, template: int) -> int:
        """Diagonals to either side of a candidate's that the band covers."""
        return max(4, len(self.words[template]) // 4)

    def align(self, ids: np.ndarray, template: int, diagonal: int) -> tuple[int, int, int]:
        """(first word, end word, matched words) of the best banded alignment.

        Least word edits of the whole template against any stretch of text
        within the band; of equal ones the first.
        """
        own, slack = self.words[template], self.slack(template)
        width, low = 2 * slack + 1, diagonal - slack
        # Edits less the place in the band, so that a skipped text word costs nothing here.
        table = np.empty((len(own) + 1, width), np.int32)
        table[0] = -np.arange(width)
        text = np.full(len(own) + width, -1, np.int32)
        a, b = self.reach(template, diagonal)
        b = min(len(ids), b)
        if a < b:
            text[a - low : b - low] = ids[a:b]
        for i in range(1, len(own) + 1):
            best = table[i - 1] + (text[i - 1 : i - 1 + width] != own[i - 1])
            np.minimum(best[:-1], table[i - 1][1:] + 2, out=best[:-1])
            np.minimum.accumulate(best, out=table[i])
        i, j = len(own), int((table[-1] - table[0]).argmin())
        end, matched, first, last = low + i + j, 0, None, None
        while i:
            here, same = table[i, j], text[i - 1 + j] == own[i - 1]
            if here == table[i - 1, j] + (not same):
                if same:
                    matched += 1
                    first = low + i - 1 + j
                    last = first if last is None else last
                i -= 1
            elif j + 1 < width and here == table[i - 1, j + 1] + 2:
                i, j = i - 1, j + 1
            else:
                j -= 1
        return (end, end, 0) if first is None else (first, last + 1, matched)

    def scan(self, text: str | None) -> list[Match]:
        """Matches in a whole text, in order; spans are code points of the text.

        Of overlapping matches of one template the best stays: most words
        matched, then shortest, then first. A match goes if one of its family
        that stays overlaps it and fits better: matched words, less the
        unmatched words of template or span, whichever are more. Equal fits
        all stay.
        """
        text = text or ""
        get = self.vocabulary.get
        # Lower-casing may change the length of a text, so words are lowered one by one.
        ids = np.fromiter((get(w, 0) for w in map(str.lower, _WORD.findall(text))), np.int64)
        if not self.longest or np.count_nonzero(ids) < self.gram:
            return []
        found = set()
        lap = 2 * self.longest
        for start in range(0, len(ids), PIECE):
            begin = max(0, start - lap)
            part = ids[begin : start + PIECE]
            found |= {(k, a + begin, b + begin, n) for k, a, b, n in self.matches(part)}
        best: list[tuple[int, int, int, int]] = []
        for k, a, b, n in sorted(found, key=lambda x: (x[0], -x[3], x[2] - x[1], x[1])):
            if not any(k == k2 and a < b2 and a2 < b for k2, a2, b2, _ in best):
                best.append((k, a, b, n))
        fit = lambda k, a, b, n: 2 * n - max(len(self.words[k]), b - a)
        kept: list[tuple[int, int, int, int]] = []
        for x in sorted(best, key=lambda x: -fit(*x)):
            if not any(self.family(x[0]) == self.family(y[0]) and x[1] < y[2] and y[1] < x[2] and fit(*x) < fit(*y) for y in kept):
                kept.append(x)
        if not kept:
            return []
        wanted = {x for _, a, b, _ in kept for x in (a, b - 1)}
        spans = {i: m.span() for i, m in enumerate(_WORD.finditer(text)) if i in wanted}
        return sorted((Match(k, spans[a][0], spans[b - 1][1], n, n / len(self.words[k])) for k, a, b, n in kept), key=lambda m: (m.start, m.end, m.template))


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", templates: dict[str, str] | None = None, min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """License passages in documents.

    One row per input row and match: ``key``, ``license`` (template name),
    ``start`` and ``end`` (code points of the text), ``matched_words`` and
    ``coverage`` (share of the template's words, ``min_coverage`` at least).
    NULL and empty texts match nothing; repeated rows each report; an empty
    table gives an empty result; other columns are ignored. Templates are
    those in code and ``long_texts()`` unless given; their index, about 2 MB,
    travels with the task.
    """
    index = Index({**TEMPLATES, **long_texts()} if templates is None else templates, min_coverage=min_coverage)
    source = docs.select(key, docs[text].cast("string").alias("__text"))

    def run(batches):
        again = lru_cache(REMEMBERED)(index.scan)
        for part in chunks(batches, "__text"):
            hits = [(i, m) for i, t in enumerate(part.column(1).to_pylist()) for m in (again(t) if len(t or "") <= REMEMBERED_CHARS else index.scan(t))]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(pa.array([i for i, _ in hits], pa.int64())),
                    pa.array([index.names[m.template] for _, m in hits], pa.string()),
                    *[pa.array([getattr(m, f) for _, m in hits], pa.int64()) for f in ("start", "end", "matched")],
                    pa.array([m.coverage for _, m in hits], pa.float64()),
                ],
                names=[key, "license", "start", "end", "matched_words", "coverage"],
            )

    return source.mapInArrow(run, f"`{key}` {source.schema[key].dataType.simpleString()}, license string, start long, end long, matched_words long, coverage double")
