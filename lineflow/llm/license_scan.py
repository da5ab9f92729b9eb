"""License scan by conditional compression.

Documents with words of license notices (HINT) are read word by word around each such word, over
line ends, blank lines and other notices, as far as a notice with the longest template can reach.
These words, with the marks behind each and single spaces between, are compressed by zstandard in overlapping windows
of each template's length, alone and with the template as raw dictionary.  Where the dictionary makes a
window smaller, the template may be there.  Every template is tried, and every such window goes on,
whatever its rank; templates too short for their own dictionary to help (TELLING) keep all windows.

There the template is aligned with the words as an exact check: a notice is confirmed if its missing and added
words are at most MOST_DIFFERENT of the template's.  Of confirmed notices that overlap, the one
from which its template's dictionary saves the most bytes wins, then the one with the most matching
words less differing ones, then the first by name.  ``reduction`` is how much smaller the dictionary makes the notice.

TEMPLATES hold notices as they stand in files: one-line mentions, headers, and whole short licenses.  Whole texts of long licenses
(thousands of words) are not among them; a caller gives these as ``templates``.

Null and empty texts have no notices.  Repeated rows are reported each.  Extra columns are
ignored.  An empty table gives no rows.  Nothing is shuffled.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from functools import cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineflow.llm.shared import text_batches

MOST_DIFFERENT = 0.15
#: Words that are aligned at once; pieces overlap by what a notice can reach.
PIECE = 4000
#: Words that windows move on by, at least; they are twice as long.
STEP = 16
#: Characters of a word with the marks behind it that are compressed; the exact check reads words whole.
WIDEST = 100
#: Bytes that a template's dictionary saves of the template itself; with fewer, compression does not tell where it is.
TELLING = 8
HINT = (
    r"(?i)licen[cs]|copyright|©|all rights reserved|public domain|permission|redistribut|warrant|merchantab|liab(le|ility)"
    r"|damages|\bas is\b|\bspdx\b|\bcc0\b|creative commons|terms and conditions|noninfringement|sublicense"
)

# Wordings of license notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with '
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License."
    ),
    "MIT": "Released under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software. THE "
        'SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS "
        "OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "ISC-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "ISC-disclaimer": (
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
        "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
        "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
        "THIS SOFTWARE."
    ),
    "BSD-2-Clause-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        'distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE "
        "ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
        "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
        "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
        "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
        "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ),
    "BSD-3-Clause-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE "
        'COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE '
        "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
        "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL "
        "DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR "
        "BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT "
        "(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE "
        "POSSIBILITY OF SUCH DAMAGE."
    ),
    "Zlib-text": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable "
        "for any damages arising from the use of this software. Permission is granted to anyone to use this software for any "
        "purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following "
        "restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original "
        "software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but "
        "is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the "
        "original software. 3. This notice may not be removed or altered from any source distribution."
    ),
    "GPL-disclaimer": (
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
        "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."
    ),
    "GPL-2.0-header": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any "
        "later version."
    ),
    "LGPL-2.1-header": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
        "License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any "
        "later version."
    ),
    "AGPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version."
    ),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version."
    ),
    "LGPL-2.1": "This library is licensed under the GNU Lesser General Public License, version 2.1.",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "BSD-3-Clause": "Released under the BSD 3-Clause License.",
    "BSD-2-Clause": "Released under the BSD 2-Clause License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0.",
    "CC0-1.0": "Dedicated to the public domain under CC0 1.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "Proprietary": "All rights reserved.",
}


_WORD = re.compile(r"[\w.+-]*\w")
_HINT = re.compile(HINT)


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _joined(marked: list[str]) -> bytes:
    return " ".join(marked).encode("utf-8", "surrogatepass")


def _marked(text: str, bounds: list[int]) -> list[str]:
    """Each word with the marks behind it, up to the next word."""
    return [" ".join(text[a:b].split())[:WIDEST] for a, b in pairwise(bounds)]


@cache
def _compressors(templates: tuple[tuple[str, str], ...]):
    """A compressor alone, and by template: one with it as dictionary, the step of its windows, whether its dictionary tells."""
    import zstandard as z

    alone, given = z.ZstdCompressor(level=19), {}
    for k, t in templates:
        bounds = [*(m.start() for m in _WORD.finditer(t.lower())), len(t.lower())]
        data, step = _joined(_marked(t.lower(), bounds)), STEP
        own = z.ZstdCompressor(level=19, dict_data=z.ZstdCompressionDict(data, dict_type=z.DICT_TYPE_RAWCONTENT))
        while step < _reach(len(bounds) - 1):
            step *= 2
        given[k] = own, step, len(alone.compress(data)) - len(own.compress(data)) >= TELLING
    return alone, given


def likely(part: list[str], templates: tuple[tuple[str, str], ...]) -> dict[str, list[tuple[int, int]]]:
    """By template, the ranges of words that it makes smaller as dictionary: windows hold any notice that begins in their first half."""
    alone, given = _compressors(templates)
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in given}
    for step in {x for _, x, _ in given.values()}:
        for a in range(0, max(1, len(part) - step), step):
            b = min(a + 2 * step, len(part))
            data = _joined(part[a:b])
            size = len(alone.compress(data))
            for k, (own, own_step, tells) in given.items():
                if own_step == step and (not tells or len(own.compress(data)) < size):
                    joins = found[k] and a <= found[k][-1][1]
                    found[k].append((found[k].pop()[0] if joins else a, b))
    return found


def _reach(size: int) -> int:
    """Words within which a notice with a template of ``size`` words lies."""
    return int(size * (1 + MOST_DIFFERENT)) + 1


@cache
def _numbered(templates: tuple[tuple[str, str], ...]):
    """A number from 1 for each word of the templates, each template's numbers, and their counts in it."""
    split = [(k, words(t)) for k, t in templates]
    split = [(k, w) for k, w in split if w]
    number = {w: n for n, w in enumerate(sorted({w for _, x in split for w in x}), 1)}
    told = [(k, np.array([number[w] for w in x])) for k, x in split]
    counts = np.array([np.bincount(x, minlength=len(number) + 1) for _, x in told])
    return number, told, counts


def _costs(template: np.ndarray, text: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Least missing and added words of the whole template with a stretch of text that ends at each place.

    ``first`` is what it costs to begin behind each place.
    """
    place, cost = np.arange(len(text) + 1), first
    for w in template:
        met = cost + 1
        met[1:] = np.minimum(met[1:], np.where(text == w, cost[:-1], len(template) + len(text) + 1))
        cost = np.minimum.accumulate(met - place) + place
    return cost


def occurrences(template: np.ndarray, counts: np.ndarray, text: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, end, missing and added words) of each notice in a text; the best is taken, then those before and behind it."""
    size, found, parts = len(template), [], [(0, len(text))]
    most = int(MOST_DIFFERENT * size)
    while parts:
        a, b = parts.pop()
        part = text[a:b]
        if size - np.minimum(np.bincount(part, minlength=len(counts)), counts).sum() > most:
            continue
        cost = _costs(template, part, np.zeros(len(part) + 1, dtype=np.int64))
        least = int(cost.min())
        if least > most:
            continue
        end = int(cost.argmin())
        end += int(np.flatnonzero(cost[end : end + most + 1] == least)[-1])
        back = part[max(0, end - size - most) : end][::-1]
        length = int(np.flatnonzero(_costs(template[::-1], back, np.arange(len(back) + 1)) == least)[-1])
        found.append((a + end - length, a + end, least))
        parts += [(a, a + end - length), (a + end, b)]
    return found


def _pieces(text: str, starts: list[int], reach: int) -> list[tuple[int, int]]:
    """Ranges of words in which notices around hints lie."""
    near = []
    for m in _HINT.finditer(text):
        a = max(0, bisect_left(starts, m.start() + 1) - 1 - reach)
        b = min(len(starts), bisect_left(starts, m.end()) + reach)
        if near and a <= near[-1][1]:
            near[-1][1] = b
        else:
            near.append([a, b])
    return [(k, min(k + PIECE + reach, b)) for a, b in near for k in range(a, b, PIECE)]


def judge(text: str, templates: tuple[tuple[str, str], ...]) -> list[tuple[int, str, float, int, int]]:
    """(line, template, size reduction, missing words, added words) of each notice."""
    text = text.lower()
    number, told, counts = _numbered(templates)
    spans = [m.span() for m in _WORD.finditer(text)]
    if not spans or not told:
        return []
    text_words = np.array([number.get(text[a:b], 0) for a, b in spans])
    sizes = counts.sum(axis=1)
    met = set()
    bounds = [*(x for x, _ in spans), len(text)]
    for a, b in _pieces(text, bounds[:-1], _reach(int(sizes.max()))):
        smaller = likely(_marked(text, bounds[a : b + 1]), templates)
        for k, (name, template) in enumerate(told):
            for x, y in smaller[name]:
                met |= {(a + x + i, a + x + j, cost, k) for i, j, cost in occurrences(template, counts[k], text_words[a + x : a + y])}
    alone, given = _compressors(templates)
    ranked = []
    for a, b, cost, k in met:
        data = _joined(_marked(text, bounds[a : b + 1]))
        name, added = told[k][0], (cost + b - a - int(sizes[k])) // 2
        size, plain = len(given[name][0].compress(data)), len(alone.compress(data))
        ranked.append((size - plain, cost - (b - a - added), name, a, b, 1 - size / plain, cost - added, added))
    taken = []
    for _, _, name, a, b, reduction, missing, added in sorted(ranked):
        at = bisect_left(taken, (a,))
        if (at == 0 or taken[at - 1][1] <= a) and (at == len(taken) or b <= taken[at][0]):
            taken.insert(at, (a, b, (text.count("\n", 0, spans[a][0]), name, reduction, missing, added)))
    return [x for _, _, x in taken]


def _judge(templates: tuple[tuple[str, str], ...]):
    kinds = [pa.int32(), pa.string(), pa.float64(), pa.int64(), pa.int64()]
    names = ["line", "license", "reduction", "missing", "added"]

    def run(batches):
        for batch in batches:
            at, found = [], []
            for k, text in enumerate(batch.column("text").to_pylist()):
                own = judge(text, templates)
                at += [k] * len(own)
                found += own
            columns = zip(*found, strict=True) if found else [[]] * len(kinds)
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(at, pa.int64())), *arrays], ["doc_id", *names])

    return run


def scan(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """Confirmed notices: doc_id, line, license, reduction, missing, added (words)."""
    text_batches(docs.sparkSession)
    fixed = tuple(sorted((templates or TEMPLATES).items()))
    rows = docs.select("doc_id", "text").filter(F.col("text").rlike(HINT))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_judge(fixed), f"doc_id {kind}, line int, license string, reduction double, missing long, added long")
