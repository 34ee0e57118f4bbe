"""Licence scan by sentences and rules.

A text is cut into fragments at sentence marks and line ends; comment marks, list
numbers and bullets are dropped, and a blank line ends a sentence. Fragments are
normalised (case, punctuation and spacing dropped), and the longest run of
fragments that spells a known licence sentence becomes its identifier, so wrapped
and commented notices read like plain ones; a document becomes the sequence of
identifiers, with None for each unknown sentence. Rules are ordered sequences of
identifiers; at each place the first rule in order of precedence that matches wins
and its sentences are used up, with at most GAP unknown sentences between two of a
rule. What no rule uses is reported as unmatched. The dictionaries travel with the
code; callers may pass larger ones.

Null and empty texts have no licences. Repeated rows are scanned each, alike.
Results keep the order of the text; a licence found twice is listed once in
``licenses``. Of two known sentences that start at one place the longer wins, so
nothing ties. An empty table gives no rows; columns besides doc_id and text are not
read, so their names cannot clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import records, small_batches

GAP = 2
_BREAK = re.compile(r"(?<=[.!?;:])\s+")
_MARKS = re.compile(r"^\s*(?:(?:/\*+!?|\*+/|\*+(?=\s|$)|//+!?|#+!?|;+|--+|<!--|%+|dnl\b|rem\b|>+|\|)\s*)*|\s*(?:\*+/|-->)?\s*$", re.I)
_ITEM = re.compile(r"(?:\(?(?:\d{1,2}|[a-z]|[ivx]{1,4})[.)]|[-*\u2022\u00b7o])", re.I)
_DROP = re.compile(r"[^a-z0-9+]+")
#: A text without any of these has no known sentence; each known sentence has one.
ANCHORS = ("licen", "released under", "permission", "rights reserved", "copyright", "warrant", "liab", "redistribut", "spdx", "public domain", "without any", "www.gnu.org", "this software", "source versions", "of the mpl")

#: Known sentences, fixed values: public licence notices as their stewards word them.
SENTENCES = {
    "rights": ["All rights reserved."],
    "mit-ref": ["Released under the MIT License.", "Licensed under the MIT License.", "This project is licensed under the MIT License.", "This software is released under the MIT License.", "License: MIT", "SPDX-License-Identifier: MIT", "The MIT License (MIT)", "MIT License"],
    "mit-grant": ['Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:'],
    "mit-notice": ["The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."],
    "mit-warranty": ['THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.'],
    "mit-liability": ["IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."],
    "apache-ref": ["Licensed under the Apache License, Version 2.0.", "This work is licensed under the Apache License, Version 2.0.", "Released under the Apache License, Version 2.0.", "Licensed under the Apache License 2.0.", "SPDX-License-Identifier: Apache-2.0", "License: Apache-2.0"],
    "apache-grant": ['Licensed under the Apache License, Version 2.0 (the "License");'],
    "apache-may": ["you may not use this file except in compliance with the License."],
    "apache-copy": ["You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"],
    "apache-warranty": ['Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'],
    "gpl3-grant": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "gpl2-grant": ["This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."],
    "gpl-warranty": ["This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."],
    "bsd-grant": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"],
    "bsd-source": ["Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."],
    "bsd-binary": ["Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."],
    "bsd-endorse": ["Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."],
    "isc-grant": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "bsd-warranty": ['THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.'],
    "bsd-liability": ["IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."],
    "bsd-advertising": ["All advertising materials mentioning features or use of this software must display the following acknowledgement:"],
    "isc-warranty": ['THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.'],
    "isc-liability": ["IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."],
    "zero-grant": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."],
    "zlib-warranty": ["This software is provided 'as-is', without any express or implied warranty."],
    "zlib-liability": ["In no event will the authors be held liable for any damages arising from the use of this software."],
    "zlib-grant": ["Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"],
    "zlib-origin": ["The origin of this software must not be misrepresented; you must not claim that you wrote the original software."],
    "zlib-altered": ["Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software."],
    "mpl-subject": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "mpl-copy": ["If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.", "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."],
    "gpl-copy": ["You should have received a copy of the GNU General Public License along with this program.", "You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.", "You should have received a copy of the GNU General Public License along with this program. If not, see <http://www.gnu.org/licenses/>."],
    "gpl-details": ["See the GNU General Public License for more details."],
    "lgpl21-grant": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."],
    "lgpl-warranty": ["This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."],
    "lgpl-details": ["See the GNU Lesser General Public License for more details."],
    "agpl3-grant": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "agpl-details": ["See the GNU Affero General Public License for more details."],
    "unlicense-grant": ["This is free and unencumbered software released into the public domain."],
    "unlicense-anyone": ["Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."],
    "boost-grant": ["Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:"],
    "boost-ref": ["Distributed under the Boost Software License, Version 1.0."],
    "cc0-ref": ["This work is dedicated to the public domain.", "Licensed under CC0 1.0.", "Released under CC0 1.0.", "SPDX-License-Identifier: CC0-1.0"],
}
#: Rules in order of precedence: licence and its sentences in order.
RULES = [
    ("MIT", ["mit-ref", "mit-grant", "mit-notice", "mit-warranty", "mit-liability"]),
    ("MIT", ["mit-grant", "mit-notice", "mit-warranty", "mit-liability"]),
    ("MIT", ["mit-grant", "mit-notice"]),
    ("BSD-4-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-advertising", "bsd-endorse", "bsd-warranty", "bsd-liability"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-warranty", "bsd-liability"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-warranty", "bsd-liability"]),
    ("GPL-3.0-or-later", ["gpl3-grant", "gpl-warranty", "gpl-details", "gpl-copy"]),
    ("GPL-2.0-or-later", ["gpl2-grant", "gpl-warranty", "gpl-details", "gpl-copy"]),
    ("Apache-2.0", ["apache-grant", "apache-may", "apache-copy", "apache-warranty"]),
    ("Apache-2.0", ["apache-grant", "apache-may"]),
    ("GPL-3.0-or-later", ["gpl3-grant", "gpl-warranty"]),
    ("GPL-2.0-or-later", ["gpl2-grant", "gpl-warranty"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("BSD-4-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-advertising"]),
    ("BSL-1.0", ["boost-grant"]),
    ("MPL-2.0", ["mpl-subject", "mpl-copy"]),
    ("Zlib", ["zlib-warranty", "zlib-liability", "zlib-grant", "zlib-origin", "zlib-altered"]),
    ("Unlicense", ["unlicense-grant", "unlicense-anyone"]),
    ("AGPL-3.0-or-later", ["agpl3-grant", "gpl-warranty", "agpl-details"]),
    ("AGPL-3.0-or-later", ["agpl3-grant"]),
    ("LGPL-2.1-or-later", ["lgpl21-grant", "lgpl-warranty", "lgpl-details"]),
    ("LGPL-2.1-or-later", ["lgpl21-grant"]),
    ("ISC", ["isc-grant", "isc-warranty", "isc-liability"]),
    ("0BSD", ["zero-grant", "isc-warranty", "isc-liability"]),
    ("0BSD", ["zero-grant"]),
    ("ISC", ["isc-grant"]),
    ("GPL-3.0-or-later", ["gpl3-grant"]),
    ("GPL-2.0-or-later", ["gpl2-grant"]),
    ("Apache-2.0", ["apache-grant"]),
    ("Apache-2.0", ["apache-ref"]),
    ("MIT", ["mit-ref"]),
    ("CC0-1.0", ["cc0-ref"]),
    ("BSL-1.0", ["boost-ref"]),
]


def families() -> tuple[dict[str, list[str]], list[tuple[str, list[str]]]]:
    """Sentences and rules of licences that differ by version or by terms."""
    sentences: dict[str, list[str]] = {}
    rules: list[tuple[str, list[str]]] = []
    starts = ("Licensed under", "This work is licensed under", "Released under", "This document is licensed under")

    def add(licence: str, names: list[str]) -> None:
        key = licence.lower() + "-ref"
        sentences[key] = [f"{s} {n}." for s in starts for n in names] + [f"SPDX-License-Identifier: {licence}", f"License: {licence}"]
        rules.append((licence, [key]))

    for terms in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND"):
        for version in ("1.0", "2.0", "2.5", "3.0", "4.0"):
            add(f"CC-{terms}-{version}", [f"CC {terms} {version}", f"CC-{terms}-{version}", f"a CC {terms} {version} license", f"the CC {terms} {version} license"])
    for short, long in (("GPL", "GNU General Public License"), ("LGPL", "GNU Lesser General Public License"), ("AGPL", "GNU Affero General Public License")):
        for version in ("2", "2.1", "3"):
            add(f"{short}-{version if '.' in version else version + '.0'}", [f"the {long}, version {version}", f"the {long} version {version}", f"the {long} v{version}", f"{short}v{version}", f"the {short} version {version}"])
    for licence, long in (("BSD-2-Clause", "BSD 2-Clause License"), ("BSD-3-Clause", "BSD 3-Clause License"), ("ISC", "ISC License"), ("Zlib", "zlib License"), ("EPL-2.0", "Eclipse Public License 2.0"), ("EUPL-1.2", "European Union Public Licence 1.2"), ("Artistic-2.0", "Artistic License 2.0"), ("Unlicense", "Unlicense"), ("WTFPL", "WTFPL"), ("ODbL-1.0", "Open Database License 1.0")):
        add(licence, [f"the {long}", long])
    add("MPL-2.0", ["the Mozilla Public License, version 2.0", "the Mozilla Public License 2.0"])
    return sentences, rules


def normal(sentence: str) -> str:
    return _DROP.sub(" ", sentence.lower()).strip()


class Dictionary:
    """Known sentences by their normal form, the word prefixes of those, and the rules by their first identifier."""

    def __init__(self, sentences: dict[str, list[str]], rules: list[tuple[str, list[str]]]):
        self.known = {normal(s): k for k, all_ in sentences.items() for s in all_}
        self.prefixes = {s[: m.start()] for s in self.known for m in re.finditer(r" |$", s)}
        self.rules = [(name, tuple(ids)) for name, ids in rules]
        self.first: dict[str, list[int]] = {}
        for i, (_, ids) in enumerate(self.rules):
            self.first.setdefault(ids[0], []).append(i)


@lru_cache(maxsize=1)
def built_in() -> Dictionary:
    more, rules = families()
    return Dictionary({**SENTENCES, **more}, [*RULES, *rules])


def fragments(text: str) -> Iterator[list[tuple[str, bool]]]:
    """For each paragraph its fragments, normalised, and whether each ends a sentence."""
    out: list[tuple[str, bool]] = []
    for line in text.splitlines():
        line = _MARKS.sub("", line)
        if not line and out:
            yield out
            out = []
        for piece in _BREAK.split(line):
            piece = piece.strip()
            if not _ITEM.fullmatch(piece) and (n := normal(piece)):
                out.append((n, piece.rstrip("\"')")[-1:] in (".", "!", "?")))
    if out:
        yield out


def identify(text: str, words: Dictionary | None = None) -> list[str | None]:
    """The identifier of each sentence, None where it is unknown."""
    words = words or built_in()
    ids: list[str | None] = []
    for paragraph in fragments(text):
        at, open_ = 0, False
        while at < len(paragraph):
            last, joined, end = -1, "", at
            while end < len(paragraph):
                joined = f"{joined} {paragraph[end][0]}" if end > at else paragraph[end][0]
                if joined in words.known:
                    last, name = end, words.known[joined]
                if joined not in words.prefixes:
                    break
                end += 1
            if last >= 0:
                ids.append(name)
                at, open_ = last + 1, False
            else:  # the fragments of an unknown sentence count once
                if not open_:
                    ids.append(None)
                open_ = not paragraph[at][1]
                at += 1
    return ids


def match(ids: list[str | None], words: Dictionary | None = None) -> tuple[list[tuple[str, int, int]], list[str]]:
    """Licences with the first and last sentence of each, and the identifiers that no rule used."""
    words = words or built_in()
    rules, first = words.rules, words.first
    used, found = [False] * len(ids), []
    # whole texts go before references inside them: longer rules first, then the order of the text
    for i, here in enumerate(ids):
        if here is None or used[i]:
            continue
        for r in first.get(here, ()):
            name, wanted = rules[r]
            at, last, ok = [i], i, True
            for w in wanted[1:]:
                nxt, unknown = last + 1, 0
                while nxt < len(ids) and (used[nxt] or ids[nxt] != w) and unknown < GAP and ids[nxt] is None:
                    nxt, unknown = nxt + 1, unknown + 1
                if nxt < len(ids) and ids[nxt] == w and not used[nxt]:
                    at.append(nxt)
                    last = nxt
                else:
                    ok = False
                    break
            if ok:
                for a in at:
                    used[a] = True
                found.append((name, i, last))
                break
    return found, [x for x, u in zip(ids, used, strict=True) if x is not None and not u]


def scan(text: str | None, words: Dictionary | None = None) -> tuple[list[tuple[str, int, int]], list[str], int]:
    if words is None:
        low = (text or "").lower()
        if not any(a in low for a in ANCHORS):
            return [], [], 0
    ids = identify(text or "", words)
    found, rest = match(ids, words)
    return found, rest, sum(x is not None for x in ids)


def _scan(batches: Iterator[pa.RecordBatch], sentences: dict[str, list[str]] | None, rules: list[tuple[str, list[str]]] | None) -> Iterator[pa.RecordBatch]:
    words = None if sentences is None else Dictionary(sentences, rules or [])
    for batch in batches:
        got = [scan(t, words) for t in batch.column("text").to_pylist()]
        yield records(
            doc_id=batch.column("doc_id"),
            n_sentences=pa.array([g[2] for g in got], pa.int64()),
            licenses=pa.array([list(dict.fromkeys(x[0] for x in g[0])) for g in got], pa.list_(pa.string())),
            matches=pa.array([[{"license": a, "first": b, "last": c} for a, b, c in g[0]] for g in got], pa.list_(pa.struct([("license", pa.string()), ("first", pa.int32()), ("last", pa.int32())]))),
            unmatched=pa.array([g[1] for g in got], pa.list_(pa.string())),
        )


def license_scan(docs: DataFrame, sentences: dict[str, list[str]] | None = None, rules: list[tuple[str, list[str]]] | None = None) -> DataFrame:
    """doc_id, recognised sentences, licences in order, their sentence ranges, and recognised sentences outside any licence."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(lambda b: _scan(b, sentences, rules), "doc_id long, n_sentences long, licenses array<string>, matches array<struct<license:string,first:int,last:int>>, unmatched array<string>")
