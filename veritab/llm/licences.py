"""Licence scans: sparse TF-IDF cosines of passages to templates, and inheritance from the nearest directory.

Every line and every block of lines of a whole text is a passage, and so is every
run of as many words as a template has, wherever in a line it stands. Passages and
templates are TF-IDF vectors over words, with document frequencies of the
templates; a word outside the templates has the greatest weight, so unrelated
prose around a notice lowers its cosine, and common words have none. The best
passage decides a file's own licence.

Short notices are one set of templates; standard headers and full licence texts
(with their openings, for files that are cut off) are another, to which blocks
and the whole text are compared. A match there goes before a notice, which may
be one that the licence itself quotes. Versions of one licence differ in little
else than the number, so a wording that names its version matches only passages
that name it too; other siblings are told apart by words that one of them lacks.

A file without one takes that of the licence file in the nearest directory
above it. Directories, not files, are joined with their ancestors.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritab.llm.common import cut, prepare, sliced, texts_of
from veritab.llm.words import COMMON_WORDS

#: Short notices and headers as they are found in files; several wordings of one licence. Only words and their counts matter.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "MIT": (
        "Released under the MIT License",
        "Licensed under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
        "SPDX-License-Identifier: MIT",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3",
        "program free software, redistributed, modified: terms of GNU General Public License, published by Free Software Foundation; version 3 of License, at option any later version",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "SPDX-License-Identifier: GPL-3.0-only",
    ),
    "GPL-2.0": ("Licensed under the GNU General Public License, version 2", "SPDX-License-Identifier: GPL-2.0-only", "SPDX-License-Identifier: GPL-2.0-or-later"),
    "LGPL-2.1": ("Licensed under the GNU Lesser General Public License, version 2.1", "SPDX-License-Identifier: LGPL-2.1-only", "SPDX-License-Identifier: LGPL-2.1-or-later"),
    "LGPL-3.0": ("Licensed under the GNU Lesser General Public License, version 3", "SPDX-License-Identifier: LGPL-3.0-only", "SPDX-License-Identifier: LGPL-3.0-or-later"),
    "AGPL-3.0": ("Licensed under the GNU Affero General Public License, version 3", "SPDX-License-Identifier: AGPL-3.0-only", "SPDX-License-Identifier: AGPL-3.0-or-later"),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/", "SPDX-License-Identifier: MPL-2.0"),
    "BSD-3-Clause": ("Licensed under the BSD 3-Clause License", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file", "SPDX-License-Identifier: BSD-3-Clause"),
    "BSD-2-Clause": ("Licensed under the BSD 2-Clause License", "SPDX-License-Identifier: BSD-2-Clause"),
    "CC-BY-4.0": ("Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License", "SPDX-License-Identifier: CC-BY-4.0"),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    "CC0-1.0": ("Released into the public domain under CC0 1.0", "SPDX-License-Identifier: CC0-1.0"),
    "ISC": ("Licensed under the ISC License", "SPDX-License-Identifier: ISC"),
    "Unlicense": ("This is free and unencumbered software released into the public domain", "SPDX-License-Identifier: Unlicense"),
}
_GNU = (
    "This {what} is free software; you can redistribute it and/or modify it under the terms of the GNU {kind} as published by the Free Software Foundation; either version {v} of the License, or (at your option) any later version. ",
    "This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind} for more details. ",
    "You should have received a copy of the GNU {kind} along with this {what}; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA.",
    "You should have received a copy of the GNU {kind} along with this {what}. If not, see <https://www.gnu.org/licenses/>.",
)


def _gnu(what: str, kind: str, v: str) -> tuple[str, ...]:
    return tuple(t.format(what=what, kind=kind, v=v) for t in (_GNU[0], _GNU[0] + _GNU[1], _GNU[0] + _GNU[1] + _GNU[2], _GNU[0] + _GNU[1] + _GNU[3]))


#: Standard headers of source files.
HEADERS: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
        "See the License for the specific language governing permissions and limitations under the License.",
    ),
    "GPL-1.0": _gnu("program", "General Public License", "1"),
    "GPL-2.0": _gnu("program", "General Public License", "2"),
    "GPL-3.0": _gnu("program", "General Public License", "3"),
    "LGPL-2.0": _gnu("library", "Library General Public License", "2"),
    "LGPL-2.1": _gnu("library", "Lesser General Public License", "2.1"),
    "LGPL-3.0": _gnu("library", "Lesser General Public License", "3"),
    "AGPL-3.0": _gnu("program", "Affero General Public License", "3"),
    "MPL-1.1": (
        "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.mozilla.org/MPL/ "
        "Software distributed under the License is distributed on an \"AS IS\" basis, WITHOUT WARRANTY OF ANY KIND, either express or implied. See the License for the specific language governing rights and limitations under the License.",
    ),
}
#: Full texts, a file each, named by licence; read on the driver.
FULL_TEXTS = Path(__file__).resolve().parent / "licence_texts"
#: Version numbers that tell licences of one family apart.
VERSIONS = {"GPL-1.0": "1", "GPL-2.0": "2", "GPL-3.0": "3", "LGPL-2.0": "2", "LGPL-2.1": "2.1", "LGPL-3.0": "3", "AGPL-3.0": "3", "MPL-1.1": "1.1", "MPL-2.0": "2"}
#: Words that a passage of a licence hasn't, but its sibling's has; a wording that has them itself may meet them.
FOREIGN = {**dict.fromkeys(("GPL-1.0", "GPL-2.0", "GPL-3.0"), frozenset({"lesser", "affero", "librarygeneral"})), "BSD-2-Clause": frozenset({"endorse"})}
#: Words of the least opening of a full text that is a template; each further one has twice as many. Texts of under LONG words have none.
OPENING, LONG = 50, 400
#: Least cosine of a match.
COSINE = 0.75
LICENCE_FILE = r"(?i)^(un)?licen[cs]e([.-].*)?$|^copying([.-].*)?$|^notice([.-].*)?$"
_TOKEN = re.compile(r"[^\W_]+(?:\.\d+)*")
_STOP = COMMON_WORDS | {"may", "can", "any", "you", "your", "copy"}


def _content(words: list[str]) -> list[str]:
    """Words without common ones; the "Library General" licence is told from a library under the General one."""
    if "library" in words:
        words = ["librarygeneral" if w == "library" and after == "general" else w for w, after in zip(words, [*words[1:], ""])]
    return [w for w in words if w not in _STOP]


def long_templates() -> dict[str, tuple[str, ...]]:
    """Headers, full texts with and without a first line that is a title, and openings of long texts."""
    out: dict[str, list[str]] = {name: list(own) for name, own in HEADERS.items()}
    for file in sorted(FULL_TEXTS.glob("*.txt")):
        text = file.read_text(encoding="utf-8")
        words = _TOKEN.findall(text.lower())
        sizes = [OPENING << k for k in range(20) if LONG <= len(words) > OPENING << k]
        out.setdefault(file.stem, []).extend([text, text.strip().partition("\n")[2], *(" ".join(words[:n]) for n in sizes)])
    return {name: tuple(own) for name, own in out.items()}


def _version_words(name: str) -> frozenset[str]:
    if name not in VERSIONS:
        return frozenset()
    numbers = {VERSIONS[name], VERSIONS[name] if "." in VERSIONS[name] else VERSIONS[name] + ".0"}
    return frozenset(p + n for n in numbers for p in ("", "v", name.partition("-")[0].lower() + "v"))


class Templates:
    """Unit TF-IDF vectors of all wordings, a row a word; without `templates`, the short notices, and the long templates aside."""

    def __init__(self, templates: dict[str, tuple[str, ...]] | None = None):
        self.long = Templates(long_templates()) if templates is None else None
        wordings = [(name, Counter(_content(_TOKEN.findall(t.lower())))) for name, own in sorted((templates or TEMPLATES).items()) for t in own]
        self.names = [name for name, _ in wordings]
        n = len(wordings)
        df = Counter(w for _, bag in wordings for w in bag)
        self.idf = {w: np.log((1 + n) / (1 + k)) + 1 for w, k in df.items()}
        self.unseen = np.log(1 + n) + 1
        self.lengths = np.array([sum(bag.values()) for _, bag in wordings])
        self.row = {w: k for k, w in enumerate(df)}
        self.unit = np.zeros((len(self.row), n))
        for k, (_, bag) in enumerate(wordings):
            norm = np.sqrt(sum((c * self.idf[w]) ** 2 for w, c in bag.items()))
            for w, c in bag.items():
                self.unit[self.row[w], k] = c * self.idf[w] / norm
        #: Of each wording, the words of which a passage must have one: those of its version, if it names it.
        self.versions = [own if own & bag.keys() else frozenset() for own, (_, bag) in ((_version_words(name), (name, bag)) for name, bag in wordings)]
        self.foreign = [FOREIGN.get(name, frozenset()) - bag.keys() for name, bag in wordings]
        self.deciding = frozenset().union(*self.versions, *self.foreign)

    def best(self, words: list[str]) -> tuple[float, str | None]:
        """(cosine, licence) of the nearest wording; ties go to the first by name."""
        return self._best(Counter(_content(words)))

    def _best(self, bag: Counter) -> tuple[float, str | None]:
        held = [w for w in bag if w in self.row]
        if not held:
            return 0.0, None
        norm = sum((c * self.idf.get(w, self.unseen)) ** 2 for w, c in bag.items())
        sums = np.array([bag[w] * self.idf[w] for w in held]) @ self.unit[[self.row[w] for w in held]]
        said = self.deciding & bag.keys()
        for k in np.argsort(-np.round(sums, 12), kind="stable").tolist():
            if (not self.versions[k] or self.versions[k] & said) and not self.foreign[k] & said:
                return float(sums[k] / np.sqrt(norm)), self.names[k]
        return 0.0, None

    def can_reach(self, words: Iterable[str], least: float) -> np.ndarray:
        """Wordings that a passage of some of `words` can be `least` near to: the others lack too much of their own length."""
        return (self.unit[[self.row[w] for w in self.row.keys() & words]] ** 2).sum(axis=0) >= least * least - 1e-9

    def windows(self, words: list[str], least: float) -> tuple[float, str | None]:
        """The best of all runs of as many words as a wording has, wherever they stand; nothing under `least`.

        Common words don't count. The sums of all windows of one length come
        from running sums: of a product, each word's share; of a squared norm,
        what a word that leaves or enters changes, by its count in the window.
        """
        words = _content(words)
        own: dict[str, int] = {}
        at = np.array([own.setdefault(w, len(own)) for w in words], dtype=np.int64)
        can = np.flatnonzero(self.can_reach(own.keys(), least) & (self.lengths <= len(words)))
        found: tuple[float, str | None] = (0.0, None)
        if not len(can):
            return found
        n = len(words)
        weight = np.array([self.idf.get(w, self.unseen) for w in own])
        rows = np.array([self.row.get(w, -1) for w in own])
        place = np.sort(at * (n + 1) + np.arange(n))  # of each word in order, its places
        begins = np.searchsorted(place, np.arange(len(own)) * (n + 1))
        x = weight[at]

        def count(of: np.ndarray, before: np.ndarray) -> np.ndarray:
            """How often the word at each place `of` stands before each place `before`."""
            return np.searchsorted(place, at[of] * (n + 1) + before) - begins[at[of]]

        for size in np.unique(self.lengths[can]).tolist():
            starts = np.arange(n - size)  # windows that have one after them
            leaves = count(starts, starts + size) - count(starts, starts)
            enters = count(starts + size, starts + size + 1) - count(starts + size, starts + 1)
            change = (2 * enters - 1) * x[starts + size] ** 2 - (2 * leaves - 1) * x[starts] ** 2
            first = np.bincount(at[:size], minlength=len(own))
            norm = np.sqrt(np.maximum(np.cumsum(np.concatenate([[((first * weight) ** 2).sum()], change])), 1e-9))
            for k in can[self.lengths[can] == size].tolist():
                sums = np.concatenate([[0.0], np.cumsum(x * np.where(rows >= 0, self.unit[rows, k], 0.0)[at])])
                near = (sums[size:] - sums[:-size]) / norm
                for deciding, wanted in ((self.versions[k], True), (self.foreign[k] & own.keys(), False)):
                    if deciding:
                        said = np.concatenate([[0], np.cumsum(np.array([w in deciding for w in own])[at])])
                        near = np.where((said[size:] > said[:-size]) == wanted, near, 0.0)
                p = int(np.argmax(near))
                if near[p] >= least and near[p] > found[0] + 1e-9:
                    found = (float(near[p]), self.names[k])
        return found

    def scan(self, text: str | None, least: float = COSINE) -> tuple[float, str | None]:
        """The best of all lines, of all blocks of non-empty lines, of the whole text, and of windows.

        Long templates are compared with blocks and the whole text where they
        can be `least` near, and then go before the notices. Windows, of the
        length of each template, count where they reach `least`.
        """
        found: tuple[float, str | None] = (0.0, None)
        block: list[str] = []
        blocks: list[list[str]] = []
        held = 0  # lines of the block that share a word with a template
        lines = 0
        for line in [*(text or "").split("\n"), ""]:
            words = _TOKEN.findall(line.lower())
            if words:
                hit = not self.row.keys().isdisjoint(words)
                if hit:
                    found = max(found, self.best(words), key=lambda f: f[0])
                block += words
                held += hit
                lines += 1
                continue
            if held and lines > 1:
                found = max(found, self.best(block), key=lambda f: f[0])
            if block:
                blocks.append(block)
            block, held, lines = [], 0, 0
        words = [w for own in blocks for w in own]
        found = max(found, self.windows(words, least), key=lambda f: f[0])
        if self.long is None:
            return found
        bag = Counter(_content(words))
        if self.long.can_reach(bag.keys(), least).any():
            far = max((self.long._best(bag), *map(self.long.best, blocks), self.long.windows(words, least)), key=lambda f: f[0])
            found = far if far[0] >= least else max(found, far, key=lambda f: f[0])
        return found


def own_licences(files: DataFrame, templates: dict[str, tuple[str, ...]] | None = None, cosine: float = COSINE) -> DataFrame:
    """(file_id, path, own_licence, cosine) of every row of `files` (file_id long, path string, text string).

    own_licence is null where no passage reaches `cosine`; so for null and
    empty texts. The cosine is rounded to six places.
    """
    prepare(files.sparkSession)
    model = files.sparkSession.sparkContext.broadcast(Templates(templates))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model.value
        for batch in sliced(batches):
            found = [own.scan(t, cosine) for t in texts_of(batch, 2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([n if c >= cosine else None for c, n in found], pa.string()), pa.array([round(c, 6) for c, _ in found], pa.float64())], ["file_id", "path", "own_licence", "cosine"]
            )

    own = files.select(F.col("file_id").cast("long").alias("file_id"), F.col("path").cast("string").alias("path"), F.col("text").cast("string").alias("text"))
    return own.mapInArrow(run, "file_id long, path string, own_licence string, cosine double")


def inherited(found: DataFrame) -> DataFrame:
    """`found` of `own_licences` with licence, inherited_from and levels_up.

    A file with a licence of its own keeps it (levels_up 0 and inherited_from
    null). Another takes that of the nearest directory at or above its own
    that holds a licence file with a licence (levels_up 1 for its own
    directory); several in one directory: the best cosine, then the least
    name. Null paths inherit nothing. The frame is checkpointed: texts are
    scanned once.
    """
    found = cut(found)
    split = found.withColumn("_dir", F.when(F.col("path").contains("/"), F.regexp_replace("path", "/[^/]*$", "")).otherwise(F.when(F.col("path").isNotNull(), F.lit(""))))
    named = split.where(F.regexp_extract("path", "[^/]*$", 0).rlike(LICENCE_FILE) & F.col("own_licence").isNotNull())
    held = named.groupBy("_dir").agg(F.min(F.struct((-F.col("cosine")).alias("c"), F.col("own_licence").alias("name"))).alias("best")).select(F.col("_dir").alias("_above"), F.col("best.name").alias("_licence"))
    dirs = split.where("own_licence is null and _dir is not null").select("_dir").distinct()
    parts = F.split("_dir", "/")
    above = F.transform(F.sequence(F.size(parts), F.lit(0), F.lit(-1)), lambda k: F.array_join(F.slice(parts, F.lit(1), k), "/"))
    climbed = dirs.select("_dir", F.posexplode(above).alias("_up", "_above")).join(held, "_above")
    nearest = climbed.groupBy("_dir").agg(F.min(F.struct("_up", "_above", "_licence")).alias("n"))
    out = split.join(nearest, "_dir", "left")
    own = F.col("own_licence").isNotNull()
    return out.select(
        "file_id", "path", "own_licence", "cosine", F.when(own, F.col("own_licence")).otherwise(F.col("n._licence")).alias("licence"),
        F.when(~own, F.col("n._above")).alias("inherited_from"), F.when(own, 0).otherwise(F.col("n._up") + 1).cast("int").alias("levels_up"),
    )


def document_files(docs: DataFrame) -> DataFrame:
    """A documents table as a tree of files: source/language/number of 256 ids/file.

    As documents have no path of their own, three of each 256 ids stand for
    licence files, at every level of the tree: the first for its directory's,
    the 65th for the language's and the 129th for the source's. Nulls are
    "none".
    """
    ident = F.col("doc_id").cast("long")
    place = F.pmod(ident, F.lit(256))
    source, lang = (F.coalesce(F.col(c).cast("string"), F.lit("none")) for c in ("source", "lang"))
    leaf = F.floor(ident / 256).cast("string")
    shared = F.concat(F.lit("LICENSE."), ident.cast("string"))  # an upper directory has many
    path = (
        F.when(place == 128, F.concat_ws("/", source, shared))
        .when(place == 64, F.concat_ws("/", source, lang, shared))
        .otherwise(F.concat_ws("/", source, lang, leaf, F.when(place == 0, F.lit("LICENSE")).otherwise(F.concat(ident.cast("string"), F.lit(".txt")))))
    )
    return docs.select(ident.alias("file_id"), path.alias("path"), "text")


def scan_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, path, own_licence, cosine, licence, inherited_from, levels_up) of every row of a documents table."""
    return inherited(own_licences(document_files(docs))).withColumnRenamed("file_id", "doc_id")
