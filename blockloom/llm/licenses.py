"""License scans: sparse TF-IDF likeness of runs of lines and license files to templates, and inheritance along directories.

Units are every line of every whole text, all runs of consecutive lines from each line on (lines without a word left out)
up to ``REACH`` times the words of the longest template, so that a wrapped notice or header block is compared whole, and
the whole text of a file that is named like a license.  Runs of more than ``EACH`` lines grow by an eighth at a time.  A
unit's vector holds tf * idf of its words (lower case, ASCII letters and digits and what lies beyond ASCII); document counts
come from one pass over all texts into counters of a fixed size.  A unit has the license of the likeliest template from
``MIN_COSINE`` on.  A full notice (``NOTICES``) goes before a sentence (``TEMPLATES``): notices hold sentences that others
share.  Dot products are differences of running sums over template words; a bound from them and from the sum of squared
idf leaves only a few units whose full length is needed.

A file has the license of its own likeliest unit, else that of the nearest directory upwards with a license file: the
distinct directories are expanded to their ancestors and joined by path.  Null paths have no directory and inherit
nothing, null texts have no units; between licenses of equal likeness the first by name counts.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockloom.llm import sketch
from blockloom.llm.tables import each_batch, join_small, pick, stored
from blockloom.llm.words import SLICE_BYTES, Spans, line_groups, pieces, raw, slices, spans

MIN_COSINE = 0.7
REACH = 1.5
EACH = 32
LICENSE_FILE = r"(?i)^(licen[sc]e|copying|notice)([.-].*)?$"


def _granted(work: str, name: str, version: str) -> str:
    return f"This {work} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version."


def _header(work: str, name: str, version: str) -> str:
    """The notice that the GNU licenses ask for in each file."""
    return (
        f"{_granted(work, name, version)} This {work} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. "
        f"See the GNU {name} for more details. You should have received a copy of the GNU {name} along with this {work}. If not, see <https://www.gnu.org/licenses/>."
    )


def _title(name: str, version: str, years: str, address: str) -> str:
    """How the text of a GNU license begins."""
    return f"GNU {name} Version {version} Copyright (C) {years} Free Software Foundation, Inc. {address} Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed."


_STREET = "51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA"
_FSF = "<https://fsf.org/>"
_BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
_BSD_1 = "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
_BSD_2 = "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
_BSD_3 = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. "
_BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. '
    "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_MIT = (
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
    "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
)
_MIT_END = (
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, '
    "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_GPL, _LGPL, _AGPL = "General Public License", "Lesser General Public License", "Affero General Public License"

#: Templates: wordings by which licenses are named in headers and files (fixed values).
TEMPLATES: Mapping[str, tuple[str, ...]] = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License, either version 3 of the License, or any later version.",
        _granted("program", _GPL, "3"),
    ),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2.", _granted("program", _GPL, "2")),
    "LGPL-2.1": ("This work is licensed under the GNU Lesser General Public License, version 2.1.", _granted("library", _LGPL, "2.1")),
    "LGPL-3.0": ("This work is licensed under the GNU Lesser General Public License, version 3.", _granted("program", _LGPL, "3")),
    "AGPL-3.0": ("This work is licensed under the GNU Affero General Public License, version 3.", _granted("program", _AGPL, "3")),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Licensed under the BSD 3-Clause License.",
    ),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under the Creative Commons Attribution 4.0 International License."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License."),
    "proprietary": ("All rights reserved.", "Copyright. All rights reserved."),
}
#: Full notices, and how the texts of the long licenses begin.
NOTICES: Mapping[str, tuple[str, ...]] = {
    "MIT": (_MIT, _MIT + _MIT_END),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER '
        "RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    "Apache-2.0": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 '
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. '
        "See the License for the specific language governing permissions and limitations under the License.",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION",
    ),
    "GPL-2.0": (_header("program", _GPL, "2"), _title(_GPL, "2, June 1991", "1989, 1991", _STREET)),
    "GPL-3.0": (_header("program", _GPL, "3"), _title(_GPL, "3, 29 June 2007", "2007", _FSF)),
    "LGPL-2.1": (_header("library", _LGPL, "2.1"), _title(_LGPL, "2.1, February 1999", "1991, 1999", _STREET)),
    "LGPL-3.0": (_header("program", _LGPL, "3"), _title(_LGPL, "3, 29 June 2007", "2007", _FSF)),
    "AGPL-3.0": (_header("program", _AGPL, "3"), _title(_AGPL, "3, 19 November 2007", "2007", _FSF)),
    "BSD-2-Clause": (_BSD + _BSD_1 + _BSD_2 + _BSD_END,),
    "BSD-3-Clause": (_BSD + _BSD_1 + _BSD_2 + _BSD_3 + _BSD_END,),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
        'Mozilla Public License Version 2.0 1. Definitions 1.1. "Contributor" means each individual or legal entity that creates, contributes to the creation of, or owns Covered Software.',
    ),
}

_PLAIN = np.full(256, 0x20, np.uint8)
_PLAIN[0x0A] = 0x0A
_PLAIN[48:58], _PLAIN[97:123], _PLAIN[65:91] = range(48, 58), range(97, 123), range(97, 123)
_PLAIN[128:] = range(128, 256)


def _cleaned(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Parts of texts: number of the first text, cleaned bytes, offsets; a long text comes in groups of whole lines."""
    data, offsets = raw(column)
    for at, to in slices(offsets):
        part = _PLAIN[data[offsets[at] : offsets[to]]]
        if to - at == 1 and len(part) > 2 * SLICE_BYTES:
            for group in line_groups(part):
                for piece in pieces(group) if len(group) > 2 * SLICE_BYTES else (group,):
                    yield at, piece, np.array([0, len(piece)])
        else:
            yield at, part, offsets[at : to + 1] - offsets[at]


def _document_words(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    held: dict[int, list[np.ndarray]] = {}
    for at, part, own in _cleaned(batch["text"]):
        s = spans(part, own)
        hashes, ends = s.hashes(), np.searchsorted(s.starts, own)
        for i in range(len(own) - 1):
            held.setdefault(at + i, []).append(hashes[ends[i] : ends[i + 1]])
    for found in held.values():
        yield np.unique(np.concatenate(found))


class Matcher:
    """Vectors of some templates, and what units are likest to them."""

    def __init__(self, idf: np.ndarray, names: list[str], templates: Mapping[str, tuple[str, ...]], least: float):
        self.all_idf, self.least = idf, least
        texts = [(names.index(n), t) for n in sorted(templates) for t in templates[n]]
        words = []
        for _, t in texts:
            part = _PLAIN[np.frombuffer(t.encode(), np.uint8)]
            words.append(spans(part, np.array([0, len(part)])).hashes())
        self.vocabulary = np.unique(np.concatenate(words))
        own_idf = idf[sketch.counter_of(self.vocabulary)]
        vectors = np.zeros((len(texts), len(self.vocabulary)))
        for row, own in zip(vectors, words):
            np.add.at(row, np.searchsorted(self.vocabulary, own), 1)
        vectors *= own_idf
        vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
        self.weights = own_idf[:, None] * vectors.T  # what a word adds to the dot product with each template
        self.most = self.weights.max(axis=1)
        self.license = np.array([i for i, _ in texts])
        self.reach = int(REACH * max(len(w) for w in words))

    def _place(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which words are template words, and their places in the vocabulary."""
        place = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        hit = np.flatnonzero(self.vocabulary[place] == hashes)
        return hit, place[hit]

    def match(self, hashes: np.ndarray) -> tuple[float, int]:
        """Likeness and license of the likest template."""
        words, tf = np.unique(hashes, return_counts=True)
        hit, place = self._place(words)
        cosine = tf[hit] @ self.weights[place] / max(float(np.linalg.norm(tf * self.all_idf[sketch.counter_of(words)])), 1e-12)
        best = int(cosine.argmax())
        return round(float(cosine[best]), 12), int(self.license[best])

    def runs(self, hashes: np.ndarray, squares: np.ndarray, edges: np.ndarray, doc: np.ndarray, line: np.ndarray, best: list[tuple[float, int, int] | None]) -> None:
        """Raise (likeness, -license, -line) in ``best`` by runs of lines.

        Line i has the words edges[i]:edges[i+1]; ``squares`` are running sums of squared idf, of which a unit's squared
        length is at least the difference.
        """
        hit, place = self._place(hashes)
        most = np.zeros(len(hashes) + 1)
        most[hit + 1] = self.most[place]
        most = np.cumsum(most)
        dots, before = None, np.searchsorted(hit, edges)
        floor = np.array([self.least if b is None else b[0] for b in best])
        live, k, n = np.arange(len(doc)), 1, len(doc)
        while len(live):
            length = np.sqrt(np.maximum(squares[edges[live + k]] - squares[edges[live]], 1e-12))
            need = floor[doc[live]] + (1e-9 if k > 1 else -1e-9)
            some = np.flatnonzero((np.minimum((most[edges[live + k]] - most[edges[live]]) / length, 1) >= need - 1e-9))
            if len(some):
                if dots is None:
                    dots = np.concatenate([np.zeros((1, len(self.license))), np.cumsum(self.weights[place], axis=0)])
                bound = np.minimum((dots[before[live[some] + k]] - dots[before[live[some]]]).max(axis=1) / length[some], 1)
                near = np.flatnonzero(bound >= need[some] - 1e-9)
                for j in near[np.argsort(-bound[near], kind="stable")]:
                    i = live[some[j]]
                    at = int(doc[i])
                    if bound[j] < floor[at] + (1e-9 if k > 1 else -1e-9) - 1e-9:
                        continue
                    cosine, name = self.match(hashes[edges[i] : edges[i + k]])
                    found = (cosine, -name, -int(line[i]))
                    if cosine >= self.least and (best[at] is None or (cosine > best[at][0] + 1e-9 if k > 1 else found > best[at])):
                        best[at], floor[at] = found, cosine
            k += 1 if k < EACH else k // 8
            live = live[live + k <= n]
            live = live[(doc[live + k - 1] == doc[live]) & (edges[live + k] - edges[live] <= self.reach)]


class Scanner:
    """The ranks are sets of templates; a license of an earlier rank goes before one of a later rank."""

    def __init__(self, counters: np.ndarray, docs: int, ranks: Sequence[Mapping[str, tuple[str, ...]]], least: float):
        self.idf = np.log((1 + docs) / (1 + np.minimum(counters, docs))) + 0.1
        self.names = sorted({n for templates in ranks for n in templates})
        self.ranks = [Matcher(self.idf, self.names, templates, least) for templates in ranks if templates]
        self.least = least

    def scan(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        k = batch.num_rows
        found: list[list[tuple[float, int, int] | None]] = [[None] * k for _ in self.ranks]
        before = np.zeros(k, np.int64)  # lines of a text seen in earlier parts
        files: dict[int, list[np.ndarray]] = {}
        whole = batch["license_file"].to_pylist()
        reach = max(m.reach for m in self.ranks)
        tail, last = (np.zeros(0, np.uint64), np.zeros(0, np.int64)), -1
        for at, part, own in _cleaned(batch["text"]):
            s: Spans = spans(part, own)
            hashes = s.hashes()
            starts = np.unique(np.concatenate([own[:-1], np.flatnonzero(part == 0x0A) + 1]))
            unit = np.searchsorted(starts, s.starts, "right") - 1
            first = np.searchsorted(starts, own[:-1])
            owner = np.searchsorted(own, s.starts, "right") - 1
            line = unit - first[owner] + before[at + owner]
            ends = np.searchsorted(s.starts, own)
            for i in range(len(own) - 1):
                before[at + i] += int((part[own[i] : own[i + 1]] == 0x0A).sum())
                if whole[at + i]:
                    files.setdefault(at + i, []).append(hashes[ends[i] : ends[i + 1]])
            if at == last:  # a later part of a long text: runs that began in the part before
                owner = np.concatenate([np.zeros(len(tail[0]), np.int64), owner])
                hashes, line = np.concatenate([tail[0], hashes]), np.concatenate([tail[1], line])
            edges = np.flatnonzero((np.diff(owner, prepend=-1) != 0) | (np.diff(line, prepend=-1) != 0))
            doc, number = at + owner[edges], line[edges]
            edges = np.append(edges, len(hashes))
            squares = np.concatenate([[0], np.cumsum(self.idf[sketch.counter_of(hashes)] ** 2)])
            for matcher, best in zip(self.ranks, found):
                matcher.runs(hashes, squares, edges, doc, number, best)
            cut = edges[np.searchsorted(edges, max(len(hashes) - reach, 0))]
            tail, last = (hashes[cut:], line[cut:]), at
        for doc, parts in files.items():
            words = np.concatenate(parts)
            for matcher, best in zip(self.ranks, found):
                cosine, name = matcher.match(words)
                if cosine >= self.least and (best[doc] is None or (cosine, -name) > best[doc][:2]):
                    best[doc] = (cosine, -name, 1)
        best = [next((b for b in each if b is not None), None) for each in zip(*found)]
        return pa.RecordBatch.from_pydict(
            {
                **{c: batch[c] for c in ("id", "path", "license_file")},
                "own_license": pa.array([self.names[-b[1]] if b else None for b in best], pa.string()),
                "own_score": pa.array([b[0] if b else None for b in best], pa.float64()),
                "line": pa.array([-b[2] if b and b[2] <= 0 else None for b in best], pa.int64()),
            }
        )


def scan_licenses(
    docs: DataFrame,
    id: str = "doc_id",
    path: str = "path",
    text: str = "text",
    templates: Mapping[str, tuple[str, ...]] = TEMPLATES,
    least: float = MIN_COSINE,
    notices: Mapping[str, tuple[str, ...]] = NOTICES,
) -> DataFrame:
    """(id, path, own_license, own_score, line, license, inherited_from) of every row.

    ``line`` is the number of the first line of the likeliest unit from 0 on, null if the whole file was likelier; ``inherited_from`` is the
    directory whose license file gave the license, null if the file has one of its own or none at all.
    """
    rows = pick(docs, id=id, path=path, text=text).select("id", F.col("path").cast("string"), F.col("text").cast("string"))
    rows = rows.withColumn("license_file", F.coalesce(F.rlike(F.regexp_extract("path", "([^/]*)$", 1), F.lit(LICENSE_FILE)), F.lit(False)))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return sketch.counted(batches, _document_words)

    counters = sketch.gather(rows.select("text").mapInArrow(counted, "slice int, counts binary"))
    scanner = Scanner(counters, rows.count(), (notices, templates), least)
    kind = rows.schema["id"].dataType.simpleString()
    found = rows.mapInArrow(each_batch(scanner.scan), f"id {kind}, path string, license_file boolean, own_license string, own_score double, line bigint")
    found = stored(found.withColumn("dir", F.when(F.contains("path", F.lit("/")), F.regexp_replace("path", "/[^/]*$", "")).otherwise(F.when(F.col("path").isNotNull(), ""))))
    given = found.where("license_file AND own_license IS NOT NULL AND dir IS NOT NULL").groupBy(F.col("dir").alias("up")).agg(F.max(F.struct("own_score", F.col("own_license").alias("name"))).alias("best"))
    given = given.select("up", F.col("best.name").alias("name"))
    dirs = found.select("dir").where("dir IS NOT NULL").distinct()
    parts = F.split("dir", "/")
    ups = F.concat(F.array(F.lit("")), F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "/")))
    expanded = dirs.select("dir", F.posexplode(F.when(F.col("dir") == "", F.array(F.lit(""))).otherwise(ups)).alias("depth", "up"))
    nearest = join_small(expanded, given, "up").where("name IS NOT NULL").groupBy("dir").agg(F.max_by(F.struct("name", "up"), "depth").alias("heir"))
    out = join_small(found, nearest, "dir")
    own = F.col("own_license").isNotNull()
    return out.select(
        F.col("id").alias(id),
        "path",
        "own_license",
        "own_score",
        "line",
        F.coalesce("own_license", "heir.name").alias("license"),
        F.when(~own, F.col("heir.up")).alias("inherited_from"),
    )
