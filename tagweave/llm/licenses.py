"""License scanning with a generalised suffix automaton over template words.

One automaton holds every word run of every template.  A text streams through
it once: each word moves to the longest run of template words that ends there
(the matching statistics).  Runs that cannot grow further and are long enough
name their places in the templates, and runs of one template that lie in order
and close together chain into a span: every run takes the best of all chains that
it can go on from, so a stray run in between breaks none.  A template is found
when a chain covers enough of its words, so reflowed, cut or slightly edited
notices are found.

The base phrases are templates too; a phrase stands wherever the current run
ends with it, which the automaton's suffix links tell.

The automaton depends on the templates alone (bounded, broadcast); texts are
never shuffled.  Work is linear in the text for given templates: a run looks back
over its own length and the gap.

Defined results: words are runs of 0-9, a-z (A-Z lower-cased) and anything
above ASCII; null and empty texts have no words, no labels and score 0; repeated
rows each get their own; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagweave.llm.common import small_batches

PART_CHARS = 1 << 20
MIN_RUN = 3        # words of a run that may start or extend a chain
MAX_GAP = 6        # words that may be skipped between two runs of a chain, in the text and in the template
MIN_COVER = 0.75   # share of a template's words that a chain must cover
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")

# The base phrases and their labels.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Public license notices and texts, and the usual one-line references to them: (label, text).
TEMPLATES = [
    ("gpl-3.0", "licensed under the GNU General Public License, version 3"),
    ("gpl-2.0", "licensed under the GNU General Public License, version 2"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation"),
    ("gpl", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even "
            "the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE"),
    ("lgpl", "GNU Lesser General Public License as published by the Free Software Foundation"),
    ("agpl", "GNU Affero General Public License as published by the Free Software Foundation"),
    ("apache-2.0", "licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("apache-2.0", "distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS "
                   "OF ANY KIND, either express or implied"),
    ("mit", "released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the Software), to deal in the Software without restriction"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial "
            "portions of the Software"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met"),
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
            "following disclaimer"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by-nc-4.0", "licensed under CC BY-NC 4.0"),
    ("cc-by-sa-4.0", "licensed under CC BY-SA 4.0"),
    ("cc-by-4.0", "licensed under CC BY 4.0"),
    ("cc-by-4.0", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc0-1.0", "has waived all copyright and related or neighboring rights to this work"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice
        and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS
        PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
        MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT
        HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
        ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("bsd-2-clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided
        that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this
        list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright
        notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided
        with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR
        IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A
        PARTICULAR PURPOSE ARE DISCLAIMED."""),
    ("bsd-3-clause", """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
        promote products derived from this software without specific prior written permission."""),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS
        PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES
        OF MERCHANTABILITY AND FITNESS."""),
    ("zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
        liable for any damages arising from the use of this software. Permission is granted to anyone to use this software
        for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the
        following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote
        the original software. If you use this software in a product, an acknowledgment in the product documentation would be
        appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be
        misrepresented as being the original software. 3. This notice may not be removed or altered from any source
        distribution."""),
    ("apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
        required by applicable law or agreed to in writing, software distributed under the License is distributed on an
        "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
        specific language governing permissions and limitations under the License."""),
    ("unlicense", """Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source
        code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."""),
]


def words_of(text: str | None) -> list[bytes]:
    return _WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())


@dataclass
class Automaton:
    """Generalised suffix automaton of word sequences."""

    next: list[dict[bytes, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    size: list[int] = field(default_factory=lambda: [0])
    places: list[list[tuple[int, int]]] = field(default_factory=lambda: [[]])  # (sequence, end) of the state's runs

    def add(self, sequence: int, words: list[bytes]) -> None:
        last = 0
        for end, w in enumerate(words, 1):
            last = self._extend(last, w)
            self.places[last].append((sequence, end))

    def _state(self, size: int, follow: dict, link: int) -> int:
        self.next.append(follow)
        self.size.append(size)
        self.link.append(link)
        self.places.append([])
        return len(self.next) - 1

    def _split(self, p: int, w: bytes, q: int) -> int:
        """The state of run p + w alone, taken out of q where q also holds longer runs."""
        if self.size[q] == self.size[p] + 1:
            return q
        clone = self._state(self.size[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, w: bytes) -> int:
        if w in self.next[last]:
            return self._split(last, w, self.next[last][w])
        new = self._state(self.size[last] + 1, {}, 0)
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, w, self.next[p][w])
        return new

    def close(self) -> None:
        """Hand every place up the suffix links: a state then knows all ends of its runs."""
        for v in sorted(range(1, len(self.next)), key=lambda s: -self.size[s]):
            if self.link[v] > 0:
                self.places[self.link[v]].extend(self.places[v])
        self.places = [sorted(set(p)) for p in self.places]
        self.places[0] = []


class Scanner:
    """The automaton of phrases and templates, and the scan of one text."""

    def __init__(self, phrases: dict[str, str] | None = None, templates: list[tuple[str, str]] | None = None):
        phrases = BASE_PHRASES if phrases is None else phrases
        templates = TEMPLATES if templates is None else templates
        self.sequences = [words_of(p) for p in phrases] + [words_of(t) for _, t in templates]
        self.labels = list(phrases.values()) + [label for label, _ in templates]
        self.n_phrases = len(phrases)
        self.sam = Automaton()
        for i, words in enumerate(self.sequences):
            self.sam.add(i, words)
        self.sam.close()
        # Phrases that end every run of a state which is at least as long as they are.
        at: dict[int, list[int]] = {}
        for i, words in enumerate(self.sequences[:self.n_phrases]):
            v = 0
            for w in words:
                v = self.sam.next[v][w]
            at.setdefault(v, []).append(i)
        self.ends: list[list[tuple[int, int]]] = [[] for _ in self.sam.next]
        for v in sorted(range(len(self.sam.next)), key=lambda s: self.sam.size[s]):
            up = self.sam.link[v]
            self.ends[v] = ([] if up < 0 else list(self.ends[up])) + [(len(self.sequences[i]), i) for i in at.get(v, ())]

    def scan(self, text: str | None):
        """(words, base places (start, phrase), spans (template, start, end, covered words))."""
        follow, link, size, ends = self.sam.next, self.sam.link, self.sam.size, self.ends
        words = words_of(text)
        root, v, run = follow[0], 0, 0
        base: list[tuple[int, int]] = []
        runs: list[tuple[int, int, int]] = []  # (end, length, state) of runs that the next word does not extend
        for i, w in enumerate(words):
            if not v:
                if w in root:
                    v, run = root[w], 1
                    for n, phrase in ends[v]:
                        if n <= run:
                            base.append((i + 1 - n, phrase))
                continue
            before_v, before = v, run
            while v and w not in follow[v]:
                v = link[v]
                run = size[v]
            if w in follow[v]:
                v, run = follow[v][w], run + 1
            else:
                v, run = 0, 0
            if run <= before and before >= MIN_RUN:
                runs.append((i, before, before_v))
            if ends[v]:
                for n, phrase in ends[v]:
                    if n <= run:
                        base.append((i + 1 - n, phrase))
        if run >= MIN_RUN:
            runs.append((len(words), run, v))
        return words, base, self._chains(runs)

    def _chains(self, runs):
        """Spans (template, start, end, covered words) of the chains that cover enough, none overlapping in one template."""
        matches: dict[int, list[tuple[int, int, int, int, int]]] = {}
        for end, length, state in runs:
            for t, t_end in self.sam.places[state]:
                if t >= self.n_phrases and t_end >= length:
                    matches.setdefault(t, []).append((end - length, end, t_end - length, t_end, length))
        done = []
        for t, found in matches.items():
            taken: list[tuple[int, int]] = []
            for covered, start, end in sorted(best_chains(found), key=lambda c: (-c[0], c[1], c[2])):
                if covered < MIN_COVER * len(self.sequences[t]):
                    break
                if all(end <= a or start >= b for a, b in taken):
                    taken.append((start, end))
                    done.append((t, start, end, covered))
        return sorted(done, key=lambda x: (x[1], x[2], x[0]))


def best_chains(matches: list[tuple[int, int, int, int, int]], max_gap: int = MAX_GAP) -> list[tuple[int, int, int]]:
    """(covered words, start, end) of the best chain that ends with each match.

    Matches are (start, end, start in the template, end there, length), sorted by
    end.  A match goes on from one that ends before it in both sequences, with at
    most ``max_gap`` words skipped in each; it adds the words by which it goes on.
    """
    best: list[tuple[int, int, int]] = []
    for start, end, t_start, t_end, length in matches:
        chain = (length, start, end)
        for i in range(len(best) - 1, -1, -1):
            _, e, _, t, _ = matches[i]
            if start - e > max_gap:
                break
            if e < end and t < t_end and t_start - t <= max_gap:
                covered = best[i][0] + min(t_end - t, end - e, length)
                if covered > chain[0]:
                    chain = (covered, best[i][1], end)
        best.append(chain)
    return best


_SCHEMA = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
           ("last_word", pa.int64()), ("base_labels", pa.list_(pa.string())), ("labels", pa.list_(pa.string())),
           ("score", pa.float64()),
           ("spans", pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                         ("coverage", pa.float64())])))]
_SQL = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, "
        "labels array<string>, score double, spans array<struct<label:string,start:long,end:long,coverage:double>>")


def scan_text(scanner: Scanner, text: str | None) -> tuple:
    words, base, chains = scanner.scan(text)
    starts = [s for s, _ in base]
    base_labels = sorted({scanner.labels[p] for _, p in base})
    spans = [{"label": scanner.labels[t], "start": a, "end": b, "coverage": min(1.0, n / len(scanner.sequences[t]))}
             for t, a, b, n in chains]
    labels = sorted({*base_labels, *(s["label"] for s in spans)})
    score = max([1.0 if base else 0.0, *(s["coverage"] for s in spans)])
    return (len(words), len(base), min(starts, default=None), max(starts, default=None), base_labels, labels, score, spans)


def _scan(shared):
    schema = pa.schema(_SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", PART_CHARS):
            rows = [scan_text(shared.value, t) for t in batch.column("text").to_pylist()]
            columns = [batch.column("doc_id"), *(pa.array(c, t) for c, (_, t) in zip(zip(*rows), _SCHEMA[1:]))]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def scan(docs: DataFrame, scanner: Scanner | None = None) -> DataFrame:
    """Word and base figures, labels, score and template spans (in words) of every row of ``docs``; no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(scanner or Scanner())
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_scan(shared), _SQL)
