"""License scans by matching template markup.

A template is a license notice with optional regions ``<<beginOptional>>...<<endOptional>>`` (they may nest) and
replaceable regions ``<<var;match="...">>`` or ``<<var;words=N>>`` (up to N words, each of which must match the
pattern as a whole). It is compiled to an automaton over words. A text carries the template's label where a run of
its words is accepted: all mandatory words stand there exactly, in order, and only optional or replaceable regions
differ. Starts are tried at every place of a word that a template can begin with, in texts that have the template's
longest mandatory run of words. Built in are whole texts of MIT, BSD (2 and 3 clauses), ISC and zlib, the standard
notices of Apache 2, GPL, LGPL, AGPL and MPL 2, and short references to these and Creative Commons licenses; texts whose
mandatory wording is changed or cut get no whole-text label. ``templates`` takes others.

Words are [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ of the text with A-Z lower-cased. Besides, the places of three fixed
phrases are counted (the base). score is the best accepted run's share of literal words, 0 without one.

Defined results: null and empty texts have no words, no places and no labels. Repeated rows and null ids are
scanned one by one. Whole texts are read, however long.
"""

from __future__ import annotations

import bisect
import re
from dataclasses import dataclass, field
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructField, StructType

#: The phrases of the base scan.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: Licenses and notices as their publishers word them, with what may differ marked up. First whole texts
#: (copyright lines, holders and bullets may differ), then notices that refer to a license.
TEMPLATES = [
    ("mit", """<<beginOptional>><<beginOptional>>The<<endOptional>> MIT License <<beginOptional>>(MIT)<<endOptional>><<endOptional>> <<beginOptional>>Copyright <<var;words=24>><<endOptional>>
        Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
        The above copyright notice and this permission notice <<beginOptional>>(including the next paragraph)<<endOptional>> shall be included in all copies or substantial portions of the Software.
        THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL <<var;words=12>> BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("bsd-2-clause", """<<beginOptional>>Copyright <<var;words=24>><<endOptional>>
        Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
        <<var;words=1;match="1|a">> Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
        <<var;words=1;match="2|b">> Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
        THIS SOFTWARE IS PROVIDED BY <<var;words=12>> "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL <<var;words=12>> BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("bsd-3-clause", """<<beginOptional>>Copyright <<var;words=24>><<endOptional>>
        Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
        <<var;words=1;match="1|a">> Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
        <<var;words=1;match="2|b">> Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
        <<var;words=1;match="3|c">> Neither the name of <<var;words=12>> nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
        THIS SOFTWARE IS PROVIDED BY <<var;words=12>> "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL <<var;words=12>> BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("isc", """<<beginOptional>>ISC License<<endOptional>> <<beginOptional>>Copyright <<var;words=24>><<endOptional>>
        Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
        THE SOFTWARE IS PROVIDED "AS IS" AND <<var;words=8>> DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL <<var;words=8>> BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
        Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
        <<var;words=1;match="1|a">> The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
        <<var;words=1;match="2|b">> Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
        <<var;words=1;match="3|c">> This notice may not be removed or altered from any source distribution."""),
    ("apache-2", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use <<var;words=3>> except in compliance with the License. You may obtain a copy of the License at
        <<var;words=8>> Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""),
    ("gpl-3", """<<var;words=6>> is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.
        <<beginOptional>><<var;words=6>> is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.<<endOptional>>"""),
    ("gpl-2", """<<var;words=6>> is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."""),
    ("lgpl-3", """<<var;words=6>> is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."""),
    ("lgpl-2.1", """<<var;words=6>> is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."""),
    ("agpl-3", """<<var;words=6>> is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."""),
    ("mpl-2", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at <<var;words=7>>"""),
    ("mit", "<<beginOptional>>this <<var;words=4>> is<<endOptional>> <<var;words=1;match=\"released|licensed|distributed|available\">> under the <<beginOptional>>terms of the<<endOptional>> MIT license"),
    ("apache-2", "licensed under the Apache License, version 2.0 <<beginOptional>>(the <<var;words=1>>)<<endOptional>>"),
    ("apache-2", "Apache License <<beginOptional>>version<<endOptional>> 2.0"),
    ("cc-by-nc", "licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>the<<endOptional>> CC BY-NC <<beginOptional>><<var;match=\"sa|nd\">><<endOptional>> <<var;words=2;match=\"[0-9]\">> <<beginOptional>>license<<endOptional>>"),
    ("cc-by-nc", "creative commons attribution non commercial <<beginOptional>><<var;words=2;match=\"share|alike|sharealike|no|derivatives|noderivatives\">><<endOptional>> <<var;words=2;match=\"[0-9]\">> <<beginOptional>><<var;match=\"international|unported\">><<endOptional>> license"),
    ("cc-by-nc", "creative commons attribution noncommercial <<beginOptional>><<var;words=2;match=\"share|alike|sharealike|no|derivatives|noderivatives\">><<endOptional>> <<var;words=2;match=\"[0-9]\">> <<beginOptional>><<var;match=\"international|unported\">><<endOptional>> license"),
    ("cc-by-sa", "creative commons attribution <<var;words=2;match=\"share|alike|sharealike\">> <<var;words=2;match=\"[0-9]\">> <<beginOptional>><<var;match=\"international|unported\">><<endOptional>> license"),
    ("cc-by", "creative commons attribution <<var;words=2;match=\"[0-9]\">> <<beginOptional>><<var;match=\"international|unported\">><<endOptional>> license"),
    ("cc0", "CC0 1.0 universal <<beginOptional>>public domain dedication<<endOptional>>"),
    ("gpl-3", "<<beginOptional>>this <<var;words=4>> is<<endOptional>> licensed under the <<beginOptional>>terms of the<<endOptional>> GNU General Public License, version 3 <<beginOptional>>or <<beginOptional>>at your option any<<endOptional>> later <<beginOptional>>version<<endOptional>><<endOptional>>"),
    ("gpl-3", "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the license, or (at your option) any later version"),
    ("mpl-2", "subject to the terms of the Mozilla Public License, v. 2.0"),
]

_TABLE = bytes(c if c >= 128 or 48 <= c < 58 or 97 <= c < 123 else c + 32 if 65 <= c < 91 else 32 for c in range(256))


def license_words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split() if text else []


@dataclass
class Automaton:
    """steps[state]: (word, next) or (pattern, next); free[state]: states reached without a word; state 0 starts."""

    label: str
    steps: list[list[tuple]] = field(default_factory=list)
    free: list[list[int]] = field(default_factory=list)
    end: int = 0
    anchor: bytes = b""
    begins: frozenset = frozenset()

    def state(self) -> int:
        self.steps.append([])
        self.free.append([])
        return len(self.steps) - 1

    def reach(self, states) -> set[int]:
        seen, todo = set(), list(states)
        while todo:
            s = todo.pop()
            if s not in seen:
                seen.add(s)
                todo += self.free[s]
        return seen

    def accept(self, words: list[bytes], at: int) -> tuple[int, int] | None:
        """(end, literal words) of the longest accepted run from ``at``, counting the run with most literals."""
        live, best = dict.fromkeys(self.reach([0]), 0), None
        i = at
        while live:
            if self.end in live:
                best = (i, live[self.end])
            if i == len(words):
                break
            new: dict[int, int] = {}
            for s, literal in live.items():
                for what, to in self.steps[s]:
                    fixed = isinstance(what, bytes)
                    if what == words[i] if fixed else what.fullmatch(words[i]):
                        for r in self.reach([to]):
                            new[r] = max(new.get(r, 0), literal + fixed)
            live, i = new, i + 1
        return best


def compile_template(label: str, markup: str) -> Automaton:
    a = Automaton(label)
    at, opened, run, runs = a.state(), [], [], []
    for token in re.split(r"(<<.*?>>)", markup):
        if token == "<<beginOptional>>":
            opened.append(at)
            runs, run = [*runs, run], []
        elif token == "<<endOptional>>":
            after = a.state()
            a.free[at].append(after)
            a.free[opened.pop()].append(after)
            at, run = after, []
        elif token.startswith("<<var"):
            rules = {k: x or y for k, x, y in re.findall(r';(\w+)=(?:"([^"]*)"|(\w+))', token)}
            word, after = re.compile(rules.get("match", ".*").encode(), re.S), a.state()
            for _ in range(int(rules.get("words", 1))):
                to = a.state()
                a.steps[at].append((word, to))
                a.free[at].append(after)
                at = to
            a.free[at].append(after)
            at = after
            runs, run = [*runs, run], []
        else:
            for w in license_words(token):
                to = a.state()
                a.steps[at].append((w, to))
                at = to
                if not opened:
                    run.append(w)
    runs = [*runs, run]
    a.end = at
    longest = max(runs, key=len)
    a.anchor = b" " + b" ".join(longest) + b" " if longest else b""
    starts = [w for s in a.reach([0]) for w, _ in a.steps[s]]
    a.begins = frozenset(starts) if all(isinstance(w, bytes) for w in starts) else frozenset()
    return a


class Matcher:
    def __init__(self, templates=None, phrases: dict[str, str] | None = None):
        self.automata = [compile_template(*t) for t in (TEMPLATES if templates is None else templates)]
        self.phrases = [(b" " + b" ".join(license_words(p)) + b" ", label) for p, label in (PHRASES if phrases is None else phrases).items()]

    def matches(self, text: str | None) -> tuple:
        """n_words, n_base, first_word, last_word, base_labels, labels, score."""
        words = license_words(text)
        line = b" " + b" ".join(words) + b" "
        places, base, labels, score, starts = [], set(), set(), 0.0, []
        for phrase, label in self.phrases:
            at = line.find(phrase)
            while at >= 0:
                starts = starts or list(accumulate((len(w) + 1 for w in words), initial=0))
                places.append(bisect.bisect_left(starts, at))
                base.add(label)
                at = line.find(phrase, at + 1)
        for a in self.automata:
            if a.anchor not in line:
                continue
            for i, w in enumerate(words):
                if (not a.begins or w in a.begins) and (got := a.accept(words, i)) and got[0] > i:
                    labels.add(a.label)
                    score = max(score, got[1] / (got[0] - i))
        first, last = (min(places), max(places)) if places else (None, None)
        return len(words), len(places), first, last, ",".join(sorted(base)), ",".join(sorted(base | labels)), score


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates=None, phrases: dict[str, str] | None = None) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    src = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    kinds = [*[pa.int64()] * 4, pa.string(), pa.string(), pa.float64()]

    def each(batches):
        m = Matcher(templates, phrases)
        for b in batches:
            cols = list(zip(*map(m.matches, b.column(1).to_pylist()), strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, t) for c, t in zip(cols, kinds, strict=True))], names=["doc_id", *names])

    schema = StructType([StructField("doc_id", src.schema["doc_id"].dataType)])
    for n, t in zip(names, ["long"] * 4 + ["string"] * 2 + ["double"], strict=True):
        schema = schema.add(n, t)
    return src.mapInArrow(each, schema)
