"""License scans by winnowed fingerprints and banded alignment.

Templates and texts are sequences of folded words. Of a template's runs of GRAM
words, winnowing keeps the smallest code of every WINNOW neighbours as its
fingerprints; an inverted index leads from a fingerprint to its places. Every run
of every text is looked up. The places that a text and a template share are
gathered by diagonal into candidate regions, and each region is aligned within a
band. A match is reported with its share of the template's words and its span.
Licenses of like wording are told apart by the words that tell: a match must hold
every word with a digit that its template has, and just its names and clauses. Where a
holder's name stands inside a template, as in the clauses of BSD, it may be any name.

Defined results: null or empty texts have no matches; a template is found as often
as it stands in a text; overlapping matches of one template are one, the better;
templates without words are ignored; a row given twice has its matches twice; very long
texts are scanned whole; an empty table gives no rows; other columns are kept, and one
that has the name of the result is an error.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import text as tx

GRAM = 3
WINNOW = 4
COVERAGE = 0.75
# Bytes that templates may have, as their index is sent to every task.
TEMPLATE_BYTES = 4_000_000

# Notices of common licenses in their public wording.
NOTICES = {
    "MIT": "Released under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software"),
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-text": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0"),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-text": (
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, either version "
        "3 of the License, or (at your option) any later version."),
    "BSD-text": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met"),
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-NC-4.0-text": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International "
        "License."),
    "ISC": "Released under the ISC License.",
    "ISC-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this permission "
        "notice appear in all copies"),
    "Apache-1.1": "Licensed under the Apache Software License, Version 1.1.",
    "MPL-2.0": "Licensed under the Mozilla Public License, Version 2.0.",
    "MPL-2.0-text": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a "
        "copy of the MPL was not distributed with this file, You can obtain one at "
        "https://mozilla.org/MPL/2.0/."),
    "BSD-3-Clause-text": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written "
        "permission."),
    "Unlicense-text": (
        "This is free and unencumbered software released into the public domain. Anyone is free to "
        "copy, modify, publish, use, compile, sell, or distribute this software, either in source "
        "code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any "
        "means."),
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0.",
    "Zlib-text": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will "
        "the authors be held liable for any damages arising from the use of this software."),
}
for _name, _kind, _version, _written in (
        ("GPL-2.0", "General", "2", "2"), ("LGPL-2.1", "Lesser General", "2.1", "2.1"),
        ("LGPL-3.0", "Lesser General", "3", "3"), ("AGPL-3.0", "Affero General", "3", "3")):
    NOTICES[_name] = f"This work is licensed under the GNU {_kind} Public License, version {_version}."
    NOTICES[f"{_name}-text"] = (
        f"This program is free software: you can redistribute it and/or modify it under the terms of "
        f"the GNU {_kind} Public License as published by the Free Software Foundation, either version "
        f"{_written} of the License, or (at your option) any later version.")
for _name, _date in (("GPL-2.0", "Version 2, June 1991"), ("GPL-3.0", "Version 3, 29 June 2007"),
                     ("LGPL-2.1", "Version 2.1, February 1999"),
                     ("LGPL-3.0", "Version 3, 29 June 2007"),
                     ("AGPL-3.0", "Version 3, 19 November 2007")):
    _kind = {"L": "LESSER ", "A": "AFFERO "}.get(_name[0], "")
    NOTICES[f"{_name}-body"] = (
        f"GNU {_kind}GENERAL PUBLIC LICENSE {_date} Copyright (C) {_date.split()[-1]} Free Software "
        "Foundation, Inc.")
NOTICES["Apache-2.0-body"] = (
    "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR "
    "USE, REPRODUCTION, AND DISTRIBUTION")
NOTICES["MPL-2.0-body"] = "Mozilla Public License Version 2.0 1. Definitions 1.1. \"Contributor\""
for _version, _port in (("4.0", "International"), ("3.0", "Unported")):
    for _name, _kind in (("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"),
                         ("BY-ND", "Attribution-NoDerivatives"),
                         ("BY-NC", "Attribution-NonCommercial"),
                         ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
                         ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives")):
        NOTICES.setdefault(f"CC-{_name}-{_version}", f"Licensed under CC {_name} {_version}.")
        NOTICES.setdefault(
            f"CC-{_name}-{_version}-text",
            f"This work is licensed under a Creative Commons {_kind} {_version} {_port} License.")

NOTICES["MPL-1.1-text"] = (
    "The contents of this file are subject to the Mozilla Public License Version 1.1 (the "
    "\"License\"); you may not use this file except in compliance with the License.")
# Whole texts of short licenses.
_WARRANTY = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT "
    "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
    "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES "
    "OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
    "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
NOTICES["MIT-whole"] = (
    NOTICES["MIT-text"] + ", and to permit persons to whom the Software is furnished to do so, subject to "
    "the following conditions: The above copyright notice and this permission notice shall be included in "
    "all copies or substantial portions of the Software. " + _WARRANTY)
NOTICES["ISC-whole"] = (
    NOTICES["ISC-text"] + ". THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES "
    "WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO "
    "EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY "
    "DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
    "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
    "THIS SOFTWARE.")
_BSD_CONDITIONS = (
    NOTICES["BSD-text"] + ": 1. Redistributions of source code must retain the above copyright notice, "
    "this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
    "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution.")
_BSD_WARRANTY = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR "
    "IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND "
    "FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
    "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL "
    "DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, "
    "DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER "
    "IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF "
    "THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
NOTICES["BSD-2-Clause-whole"] = f"{_BSD_CONDITIONS} {_BSD_WARRANTY}"
NOTICES["BSD-3-Clause-whole"] = (
    f"{_BSD_CONDITIONS} 3. {NOTICES['BSD-3-Clause-text']} {_BSD_WARRANTY}")
NOTICES["Zlib-whole"] = (
    NOTICES["Zlib-text"] + " Permission is granted to anyone to use this software for any purpose, "
    "including commercial applications, and to alter it and redistribute it freely, subject to the "
    "following restrictions: 1. The origin of this software must not be misrepresented; you must not "
    "claim that you wrote the original software. If you use this software in a product, an acknowledgment "
    "in the product documentation would be appreciated but is not required. 2. Altered source versions "
    "must be plainly marked as such, and must not be misrepresented as being the original software. 3. "
    "This notice may not be removed or altered from any source distribution.")
# Tags in source files.
for _name in ("MIT", "ISC", "Zlib", "Unlicense", "Apache-2.0", "BSL-1.0", "MPL-1.1", "MPL-2.0",
              "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only",
              "GPL-3.0-or-later", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only",
              "LGPL-3.0-or-later", "AGPL-3.0-only", "AGPL-3.0-or-later", "CC0-1.0", "CC-BY-4.0",
              "CC-BY-SA-4.0", "CC-BY-NC-4.0"):
    NOTICES[f"{_name}-tag"] = f"SPDX-License-Identifier: {_name}"

# Templates in which a holder's name stands.
WITH_HOLDER = ("BSD-3-Clause-text", "BSD-3-Clause-whole")
# Names and clauses, by what they say: a match has those of its template and no others.
TELLING = {w: w for w in ("mit", "isc", "apache", "bsd", "boost", "affero", "lesser", "unencumbered",
                          "gpl", "zlib", "unlicense", "only", "later", "bsl", "cc0")} | {
    "mozilla": "mpl", "mpl": "mpl", "nc": "nc", "noncommercial": "nc", "commercial": "nc", "nd": "nd",
    "noderivatives": "nd", "noderivs": "nd", "sa": "sa", "sharealike": "sa", "agpl": "affero",
    "lgpl": "lesser"}


def _apart() -> np.ndarray:
    """Everything in ASCII but letters and digits stands between words."""
    byte = np.arange(256)
    return (byte < 128) & ~np.array([chr(b).isalnum() for b in byte])


APART = _apart()


def _winnowed(codes: np.ndarray) -> np.ndarray:
    """Places of the fingerprints: the rightmost smallest code of every WINNOW neighbours."""
    n = len(codes)
    if n == 0:
        return np.zeros(0, np.int64)
    width = min(WINNOW, n)
    rows = np.arange(n - width + 1)[:, None] + np.arange(width - 1, -1, -1)
    return np.unique(rows[np.arange(len(rows)), codes[rows].argmin(axis=1)])


class Templates:
    """The words of the templates and the inverted index of their fingerprints."""

    def __init__(self, notices: dict[str, str]):
        batch = pa.RecordBatch.from_arrays([pa.array(list(notices.values()), pa.string())],
                                           names=["text"])
        self.names, self.words, self.digits, self.tells = [], [], [], []
        telling = next(tx.blocks(pa.RecordBatch.from_arrays([pa.array([" ".join(TELLING)])],
                                                            names=["text"]), "text"))
        self.telling = dict(zip(tx.words(telling, True, APART).code.tolist(), TELLING.values()))
        code, template, place = [], [], []
        for block in tx.blocks(batch, "text"):
            found = tx.words(block, True, APART)
            for i in range(block.n):
                own = found.code[found.limits[i]:found.limits[i + 1]]
                if not len(own):
                    continue
                grams = _grams(own)
                at = _winnowed(grams)
                code.append(grams[at])
                template.append(np.full(len(at), len(self.words)))
                place.append(at)
                self.names.append(list(notices)[block.first + i])
                self.words.append(own)
                at = range(found.limits[i], found.limits[i + 1])
                self.digits.append({int(found.code[w]) for w in at if any(
                    48 <= c <= 57 for c in block.data[found.start[w]:found.end[w]].tolist())})
                self.tells.append(self.said(own))
        join = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
        code = join(code, tx.U64)
        order = np.argsort(code, kind="stable")
        self.code = code[order]
        self.template, self.place = join(template, int)[order], join(place, int)[order]
        # Templates shorter than a gram are indexed by runs of their own length.
        self.sizes = sorted({min(GRAM, len(w)) for w in self.words})

    def said(self, words: np.ndarray) -> set[str]:
        return {self.telling[w] for w in words.tolist() if w in self.telling}

    def told(self, k: int, words: np.ndarray) -> bool:
        """Whether a stretch of a text has the versions, names and clauses of a template."""
        named = self.said(words)
        return self.digits[k] <= set(words.tolist()) and (
            named == self.tells[k] or self.names[k] in WITH_HOLDER and self.tells[k] <= named)


def _grams(words: np.ndarray, n: int | None = None) -> np.ndarray:
    n = min(GRAM, len(words)) if n is None else n
    at = np.arange(max(0, len(words) - n + 1))
    return tx.Rolling(words, 1).of(at, at + n)


def aligned(item: np.ndarray, text: np.ndarray, low: int, high: int):
    """Best local alignment on the diagonals low..high: matched words, and the limits of
    the stretch of the text. A match counts 2; a change, a gap and an extra word cost 1."""
    width = high - low + 1
    diagonal = np.arange(low, high + 1)
    at = np.arange(width)
    score, equal = np.zeros(width, int), np.zeros(width, int)
    start = diagonal.copy()
    best = (0, 0, 0, 0)
    for i in range(1, len(item) + 1):
        j = diagonal + i
        ok = (j >= 1) & (j <= len(text))
        same = np.zeros(width, dtype=bool)
        same[ok] = text[j[ok] - 1] == item[i - 1]
        value = np.where(ok, score + np.where(same, 2, -1), 0)
        count, begin = equal + same, start.copy()
        drop = score[1:] - 1 > value[:-1]
        value[:-1][drop] = score[1:][drop] - 1
        count[:-1][drop], begin[:-1][drop] = equal[1:][drop], start[1:][drop]
        lifted = value + at
        top = np.maximum.accumulate(lifted)
        held = np.maximum.accumulate(np.where(lifted >= top, at, 0))
        value, count, begin = top - at, count[held], begin[held]
        fresh = value <= 0
        value[fresh], count[fresh], begin[fresh] = 0, 0, j[fresh]
        score, equal, start = value, count, begin
        k = int(score.argmax())
        if score[k] > best[0]:
            best = (int(score[k]), int(equal[k]), int(start[k]), int(j[k]))
    return best[1:]


def matches(known: Templates, block: tx.Block, least: float):
    """(text, template, coverage, start, end) in code points for a block of texts."""
    found = tx.words(block, True, APART)
    whose = found.text_of()
    parts = []
    for n in known.sizes:
        if len(found.code) < n:
            continue
        code = _grams(found.code, n)
        ok = whose[:len(code)] == whose[n - 1:]
        spot = np.searchsorted(known.code, code)
        hit = np.flatnonzero(ok & (spot < len(known.code))
                             & (known.code[np.minimum(spot, len(known.code) - 1)] == code))
        if not len(hit):
            continue
        first = spot[hit]
        count = np.searchsorted(known.code, code[hit], side="right") - first
        rows = np.repeat(first - np.concatenate(([0], np.cumsum(count)))[:-1], count) \
            + np.arange(count.sum())
        where = np.repeat(hit, count)
        parts.append(np.stack((whose[where], known.template[rows],
                               where - found.limits[whose[where]] - known.place[rows])))
    if not parts:
        return []
    at = np.unique(np.concatenate(parts, axis=1), axis=1)
    text, template, diagonal = at
    # Places of one region lie on diagonals no farther apart than a band is wide.
    band = np.array([2 + len(w) // 8 for w in known.words])[template]
    new = np.ones(len(text), dtype=bool)
    new[1:] = (text[1:] != text[:-1]) | (template[1:] != template[:-1]) | (
        diagonal[1:] - diagonal[:-1] > band[1:])
    begins = np.flatnonzero(new)
    ends = np.concatenate((begins[1:], [len(text)])) - 1
    point = np.concatenate(([0], np.cumsum((block.data & 0xC0) != 0x80)))
    out = []
    for a, z in zip(begins.tolist(), ends.tolist()):
        t, k = int(text[a]), int(template[a])
        own = found.code[found.limits[t]:found.limits[t + 1]]
        size = len(known.words[k])
        lo, hi = int(diagonal[a] - band[a]), int(diagonal[z] + band[z])
        # A region of a text that repeats a notice without end is aligned step by step.
        step = max(4 * size, 64)
        for low in range(lo, hi + 1, step):
            count, s, e = aligned(known.words[k], own, low, min(low + step + size, hi))
            if count >= least * size and e > s and known.told(k, own[s:e]):
                word = found.limits[t] + np.array((s, e - 1))
                out.append((t, k, count / size,
                            int(point[found.start[word[0]]] - point[block.limits[t]]),
                            int(point[found.end[word[1]]] - point[block.limits[t]])))
    kept, taken = [], {}
    for row in sorted(set(out), key=lambda r: (r[0], r[1], -r[2], r[3], r[4])):
        # The spans kept of a template do not overlap, so their order is that of both limits.
        own = taken.setdefault(row[:2], [])
        at = bisect.bisect_left(own, (row[3], row[4]))
        if (at and own[at - 1][1] > row[3]) or (at < len(own) and own[at][0] < row[4]):
            continue
        own.insert(at, (row[3], row[4]))
        kept.append(row)
    return sorted(kept, key=lambda r: (r[0], r[3], r[4], r[1]))


def _scan(notices: dict[str, str], kept: list[str], text: str, out: str, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Templates(notices)
        for batch in batches:
            for block in tx.blocks(batch, text):
                lists = [[] for _ in range(block.n)]
                for t, k, share, a, z in matches(known, block, least):
                    lists[t].append({"license": known.names[k], "coverage": share,
                                     "start": a, "end": z})
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(block.first, block.n) for c in kept),
                     pa.array(lists, pa.list_(pa.struct([
                         ("license", pa.string()), ("coverage", pa.float64()),
                         ("start", pa.int64()), ("end", pa.int64())])))],
                    names=[*kept, out])

    return run


def scan(docs: DataFrame, keep: list[str], text: str = "text",
         notices: dict[str, str] | None = None, coverage: float = COVERAGE,
         out: str = "matches") -> DataFrame:
    """The columns `keep` of every row and, in column `out`, matches by place in the text."""
    if out in keep:
        raise ValueError(f"the rows already have a column {out}")
    notices = NOTICES if notices is None else notices
    if sum(len(t.encode()) for t in notices.values()) > TEMPLATE_BYTES:
        raise ValueError("more templates than can be sent to every task")
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    name, columns = tx.text_column(keep, text)
    return docs.select(*columns).mapInArrow(
        _scan(notices, keep, name, out, coverage), f"{kinds}, `{out}` array<struct<license: string, "
                                  "coverage: double, start: long, end: long>>")
