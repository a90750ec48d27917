"""License scan by conditional compression.

In windows about as long as a template around each mention of a license, the
template's words are aligned; those that the text lacks, in order, must be few
and none of them a number, and those that it adds must not name another license
or version.  The span of the wording is then compressed alone and
with the template as a raw dictionary, which must make it smaller by a given
share, so that the length of the text around a notice does not matter.
"""

from __future__ import annotations

import bisect
import difflib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessellum.llm import arrowtext as at

# Notices as licenses ask for them, and short forms in use.
TEMPLATES: list[tuple[str, str]] = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0'),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT license."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.'),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work. CC0 1.0 Universal."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC-BY-NC-ND-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."),
    ("LGPL-2.1", "This library is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-2.0", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Library General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
]
# Whole texts of the short licenses; of the long ones the lines of their title.
_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. '
    "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_BSD_BEGIN = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
)
_BSD_NAMES = "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. "
_BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. '
    "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_ISC_END = (
    ' THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. '
    "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, "
    "ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_APACHE_END = (
    ' Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. '
    "See the License for the specific language governing permissions and limitations under the License."
)
_ZLIB = (
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. "
    "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: "
    "The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. "
    "Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. This notice may not be removed or altered from any source distribution."
)
_LONGEST = {name: max((t for n, t in TEMPLATES if n == name), key=len) for name in ("MIT", "ISC", "Apache-2.0")}
TEMPLATES += [
    ("MIT", f"{_LONGEST['MIT']} {_AS_IS}"),
    ("BSD-3-Clause", _BSD_BEGIN + _BSD_NAMES + _BSD_END),
    ("BSD-2-Clause", _BSD_BEGIN + _BSD_END),
    ("ISC", _LONGEST["ISC"] + _ISC_END),
    ("Apache-2.0", _LONGEST["Apache-2.0"] + _APACHE_END),
    ("Zlib", _ZLIB),
]
TITLES: list[tuple[str, str]] = [
    ("MIT", "MIT License"),
    ("MIT", "The MIT License"),
    ("MIT", "The MIT License (MIT)"),
    ("ISC", "ISC License"),
    ("Zlib", "zlib License"),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("Unlicense", "The Unlicense"),
    ("Apache-2.0", "Apache License, Version 2.0"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("GPL-2.0", "GNU General Public License Version 2, June 1991"),
    ("GPL-3.0", "GNU General Public License Version 3, 29 June 2007"),
    ("LGPL-2.1", "GNU Lesser General Public License Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU Affero General Public License Version 3, 19 November 2007"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International Public License"),
    ("CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International Public License"),
    ("CC0-1.0", "Creative Commons Legal Code CC0 1.0 Universal"),
]
N_NOTICES = len(TEMPLATES)
TEMPLATES += TITLES
TEMPLATES += [(name, f"SPDX-License-Identifier: {name}") for name in dict.fromkeys(name for name, _ in TEMPLATES)]

# Words that, added to a template's, name another license.
OTHER = {"lesser", "affero", "sa", "nc", "nd", "sharealike", "noncommercial", "noderivatives", "noderivs", "clear", "modified"}

HINT = re.compile(rb"licen[sc]e|copyright|permission is|permission to use|redistribut|this software is|free software|public domain|creative commons|spdx", re.IGNORECASE)
#: Beginnings of whole texts, and about how many bytes the longest has when it is wrapped as a comment.
BEGINS = re.compile(rb"permission is|permission to use|redistribution and use|this software is|free software|license\"\);", re.IGNORECASE)
LONGEST = 2000
TEXT_HINT = re.compile(HINT.pattern.decode(), re.IGNORECASE)
WORD = re.compile(r"[^\W_]+")
#: A tag: one expression of identifiers on one line.
TAG = re.compile(r"spdx-license-identifier[ \t]*:?[ \t]*(?:[\w.+()-]+[ \t]+(?:or|and|with)[ \t]+)*\(*[\w.+-]+", re.IGNORECASE)
TAG_ENDS = re.compile(r"(?:-only|-or-later|\+)?(?![-.+]?[^\W_])", re.IGNORECASE)
VERSION_GOES_ON = re.compile(r"\.(?!0+(?!\d))\d")
CLOSING = re.compile(r"[.)\"']*")


@dataclass(frozen=True)
class LicenseScan:
    """Parameters.

    gap: lines between two mentions that still belong to one block.
    least_reduction: least share of its wording's compressed size that a template must save.
    missing: most words of a template, as a share, that a notice may lack.
    """

    gap: int = 2
    least_reduction: float = 0.2
    missing: float = 0.1


@lru_cache(maxsize=1)
def _compressors():
    plain = zstandard.ZstdCompressor(level=3, write_content_size=False)
    made = []
    for _, text in TEMPLATES:
        held = zstandard.ZstdCompressionDict(text.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        made.append(zstandard.ZstdCompressor(level=3, dict_data=held, write_content_size=False, write_dict_id=False))
    return plain, made, [[w.lower() for w in WORD.findall(text)] for _, text in TEMPLATES]


@dataclass(frozen=True)
class Notice:
    """A template found in a block: its span in characters, the share of the span's compressed size that it saves, the
    template's words that it lacks, and which words of the block it adds and matches."""

    start: int
    end: int
    template: int
    reduction: float
    lacking: tuple[str, ...]
    added: tuple[int, ...]
    matched: frozenset[int]

    @property
    def rank(self) -> tuple[float, int, int]:
        size = len(_compressors()[2][self.template])
        return len(self.lacking) / size, len(self.added), -size


def reduction(span: str, template: int) -> float:
    """The share of a span's compressed size that a template saves."""
    plain, made, _ = _compressors()
    raw = span.encode()
    alone = len(plain.compress(raw))
    return (alone - len(made[template].compress(raw))) / alone


def windows(n_words: int, mentions: list[int], size: int) -> Iterator[tuple[int, int]]:
    """Word ranges, at most three templates long, in which each mention has a template's length and some more on both sides."""
    around, covered = size + max(8, size // 4), -1
    for m in mentions:
        if m > covered:
            covered = m + around
            yield max(0, m - around), min(n_words, covered + around)


def located(block: str, words: list[tuple[str, int, int]], low: int, high: int, template: int, p: LicenseScan) -> Iterator[Notice]:
    """The places of a template's wording among the words low to high of a block; what one leaves on its sides is searched again."""
    want = _compressors()[2][template]
    most, open_ = p.missing * len(want), [(low, high)]
    while open_:
        low, high = open_.pop()
        have = [w for w, _, _ in words[low:high]]
        there = set(have)
        if sum(w not in there for w in want) > most:
            continue
        matched, lacking = [], []
        for what, a, b, c, d in difflib.SequenceMatcher(None, want, have, autojunk=False).get_opcodes():
            if what == "equal":
                matched += range(low + c, low + d)
            if what in ("delete", "replace"):
                lacking += want[a:b]
        if not matched:
            continue
        first, last = matched[0], matched[-1]
        open_ += [(low, first), (last + 1, high)]
        if len(lacking) > most or any(w.isdigit() for w in lacking):
            continue
        start, end = words[first][1], words[last][2]
        end += len(CLOSING.match(block, end).group())
        saved = reduction(block[start:end], template)
        if saved >= p.least_reduction:
            between = set(range(first, last)).difference(matched)
            yield Notice(start, end, template, saved, tuple(lacking), tuple(sorted(between)), frozenset(matched))


def _alone(block: str, start: int, end: int) -> bool:
    """Whether nothing but marks of comments and headings stands beside a span on its lines."""
    before, after = block[block.rfind("\n", 0, start) + 1 : start], block[end:].split("\n", 1)[0]
    return not (before + after).strip(" \t\r#*=/-<>;:%!.()\"'")


def another(notice: Notice, block: str, words: list[tuple[str, int, int]], used: set[int]) -> bool:
    """Whether the words about a notice, but for those of notices used before, make it another license than its template's."""
    name, text = TEMPLATES[notice.template]
    end = words[max(notice.matched)][2]
    if N_NOTICES <= notice.template < N_NOTICES + len(TITLES):
        return bool(notice.added or notice.lacking) or not _alone(block, notice.start, notice.end)
    if text.startswith("SPDX"):
        return not (TAG.fullmatch(block[notice.start : end]) and TAG_ENDS.match(block, end))
    if text.rstrip(".")[-1].isdigit() and VERSION_GOES_ON.match(block, end):
        return True
    versioned = any(w.isdigit() for w in _compressors()[2][notice.template])
    telling = [k for k in notice.added if (w := words[k][0]) in OTHER or (w.isdigit() and versioned) or (w == "library" and words[k + 1][0] == "general")]
    if not telling:
        return False
    # another notice stands between its words: it must have its own name beside that
    own = {words[k][0] for k in notice.matched - used}
    return not set(telling) <= used or not own & {w.lower() for w in WORD.findall(name)}


def recognised(block: str, p: LicenseScan) -> list[Notice]:
    """The notices of a block, least differences first; one whose words all belong to those before it is none."""
    words = [(m.group().lower(), m.start(), m.end()) for m in WORD.finditer(block)]
    starts = [a for _, a, _ in words]
    mentions = sorted({max(0, bisect.bisect_right(starts, m.start()) - 1) for m in TEXT_HINT.finditer(block)})
    found = []
    for i, want in enumerate(_compressors()[2]):
        for low, high in windows(len(words), mentions, len(want)):
            found += located(block, words, low, high, i, p)
    chosen, used = [], set()
    for notice in sorted(found, key=lambda n: (n.rank, n.start)):
        if not notice.matched <= used and not another(notice, block, words, used):
            chosen.append(notice)
            used |= notice.matched
    return sorted(chosen, key=lambda n: n.start)


def _line_end(text: bytes, at_: int) -> int:
    end = text.find(b"\n", min(at_, len(text)))
    return len(text) if end < 0 else end


def candidate_blocks(text: bytes, gap: int) -> list[tuple[int, int]]:
    """Byte spans of the runs of lines around mentions of a license.

    Where a whole text may begin the lines of the longest one follow; a title may
    go on in the next line.
    """
    found: list[list[int]] = []
    for m in HINT.finditer(text):
        start = text.rfind(b"\n", 0, m.start()) + 1
        end = _line_end(text, m.end())
        if BEGINS.match(text, m.start()):
            end = _line_end(text, m.start() + LONGEST)
        elif end - start <= 80 and text[start:end].rstrip(b" \t\r*").lower().endswith(b"license"):
            end = _line_end(text, end + 1)
        if found and (start < found[-1][1] or text.count(b"\n", found[-1][1], start) <= gap + 1):
            found[-1][1] = max(found[-1][1], end)
        else:
            found.append([start, end])
    return [(a, b) for a, b in found]


SCANNED = "doc_id bigint, n_candidates bigint, licenses string, spans string, n_differences bigint, reduction double"


def _scan(batches: Iterator[pa.RecordBatch], p: LicenseScan) -> Iterator[pa.RecordBatch]:
    known: dict[bytes, list[Notice]] = {}
    for batch in batches:
        for block in at.blocks(batch.column("text")):
            raw = block.data.tobytes()
            hits = np.array([m.start() for m in HINT.finditer(raw)], np.int64)
            n = len(block)
            candidates, names, spans, differences, saved = [0] * n, [""] * n, [""] * n, [0] * n, [0.0] * n
            for i in np.unique(np.searchsorted(block.offsets, hits, "right") - 1).tolist():
                own = raw[block.offsets[i] : block.offsets[i + 1]]
                found = []
                for a, b in candidate_blocks(own, p.gap):
                    candidates[i] += 1
                    part = own[a:b]
                    if part not in known:
                        if len(known) > 10_000:
                            known.clear()
                        known[part] = recognised(part.decode("utf-8", "replace"), p)
                    if known[part]:
                        at_ = len(own[:a].decode("utf-8", "replace"))
                        found += [(at_ + x.start, at_ + x.end, TEMPLATES[x.template][0], x) for x in known[part]]
                if found:
                    names[i] = ",".join(sorted({x[2] for x in found}))
                    spans[i] = ",".join(f"{x[2]}:{x[0]}:{x[1]}" for x in found)
                    differences[i] = sum(len(x[3].lacking) + len(x[3].added) for x in found)
                    saved[i] = max(x[3].reduction for x in found)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(block.first, n),
                    pa.array(candidates, pa.int64()),
                    pa.array(names, pa.string()),
                    pa.array(spans, pa.string()),
                    pa.array(differences, pa.int64()),
                    pa.array(saved, pa.float64()),
                ],
                names=[x.split()[0] for x in SCANNED.split(", ")],
            )


def license_scan(docs: DataFrame, p: LicenseScan = LicenseScan()) -> DataFrame:
    """(doc_id, n_candidates, licenses, spans, n_differences, reduction) for each row of docs(doc_id, text, ...).

    licenses are the identifiers found, sorted and joined by commas; spans the
    notices as identifier:start:end in characters; n_differences the words in
    which their wording differs from the templates; reduction the largest share
    of a notice's compressed size that its template saves.  Null and empty texts
    hold none.  Repeated rows and null ids are scanned like any other row; other
    columns are ignored; an empty table gives an empty one.
    """
    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return texts.mapInArrow(partial(_scan, p=p), SCANNED)
