from __future__ import annotations

from collections import Counter
from functools import cache

import numpy as np
import pytest

from veritab.llm import licences


@pytest.mark.parametrize(
    ("text", "name"),
    [
        ("Licensed under the Apache License, version 2.0.", "Apache-2.0"),
        ("some prose\n// Released under the MIT License.\nmore prose", "MIT"),
        ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0"),
        ("# SPDX-License-Identifier: MIT", "MIT"),
        ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0"),
        ("Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the Software), to deal in\nthe Software without restriction", "MIT"),
        ("a dog licence costs ten pounds in this city for the year", None),
        ("", None),
        (None, None),
    ],
)
def test_scan(text, name):
    score, found = licences.Templates().scan(text)
    assert (found if score >= licences.COSINE else None) == name


def test_cosine_against_dense_vectors():
    t = licences.Templates()
    words = "licensed under the apache license strange words".split()
    vocabulary = sorted({*t.idf, *words} - licences._STOP)
    dense = np.array([words.count(w) * t.idf.get(w, t.unseen) for w in vocabulary])
    best = 0.0
    for own in licences.TEMPLATES.values():
        for wording in own:
            bag = Counter(licences._TOKEN.findall(wording.lower()))
            v = np.array([bag[w] * t.idf.get(w, 0.0) for w in vocabulary])
            best = max(best, float(v @ dense / np.linalg.norm(v) / np.linalg.norm(dense)))
    assert t.best(words)[0] == pytest.approx(best)


_templates = cache(licences.Templates)


def _named(text):
    score, found = _templates().scan(text)
    return found if score >= licences.COSINE else None


@pytest.mark.parametrize("name", sorted(f.stem for f in licences.FULL_TEXTS.glob("*.txt")))
def test_full_texts(name):
    """As a whole with an owner, as one line, without its title, and cut off."""
    text = (licences.FULL_TEXTS / f"{name}.txt").read_text()
    rest = text.split("\n", 1)[1]
    for t in (text, f"Copyright (c) 2019 Jo Roe\n\n{text}", f"Copyright (c) 2019 Jo Roe <jo@roe.net>\nAll rights reserved.\n\n{rest}", " ".join(text.split()), text[: len(text) * 2 // 3]):
        assert _named(t) == name, t[:200]


@pytest.mark.parametrize(
    ("what", "kind", "version", "name"),
    [("program", "General", "2", "GPL-2.0"), ("program", "General", "3", "GPL-3.0"), ("library", "Lesser General", "2.1", "LGPL-2.1"), ("library", "Lesser General", "3", "LGPL-3.0"), ("program", "Affero General", "3", "AGPL-3.0"), ("program", "General", "9", None)],
)
def test_version_words_decide_between_headers(what, kind, version, name):
    header = f"""
# This {what} is free software: you can redistribute it and/or modify
# it under the terms of the GNU {kind} Public License as published by
# the Free Software Foundation, either version {version} of the License, or
# (at your option) any later version."""
    assert _named(f"# Copyright (C) 2011 Jo Roe\n{header}\n\nimport os\n") == name


def test_long_template_without_its_kind_of_text():
    assert _named("the software is a copy of the work that any person may use and the source of it is provided as is\n" * 40) is None


@pytest.mark.parametrize(
    ("text", "name"),
    [
        ("Copyright 2021 Example Corp. Released under the MIT License. See docs for details.", "MIT"),
        ("Cabbage leaves were counted twice in spring. Licensed under the Apache License, Version 2.0. Nobody knows why the rabbits came back in autumn.", "Apache-2.0"),
        ("/* lib 1.2 */ !function(a,b){return a+b} /* This work is licensed under the GNU General Public License, version 2 */ var q=function(z){return z}", "GPL-2.0"),
        ("They were released under pressure and the driver has a license of the city of Rome which nobody had ever asked to see", None),
    ],
)
def test_notices_inside_lines(text, name):
    assert _named(text) == name


@pytest.mark.parametrize(("kind", "version", "name"), [("Library General", "2", "LGPL-2.0"), ("Lesser General", "2.1", "LGPL-2.1"), ("Lesser General", "3", "LGPL-3.0"), ("Affero General", "3", "AGPL-3.0"), ("General", "2", "GPL-2.0")])
def test_windows_between_siblings(kind, version, name):
    """A window must not leave out the word that tells siblings apart."""
    text = f"Libfrob is free software; you can redistribute it and/or modify it under the terms of the GNU {kind} Public License as published by the Free Software Foundation; either version {version} of the License, or (at your option) any later version."
    assert _named(f"import os; {text} print(17)") == name


def test_three_clauses_are_not_two():
    text = (licences.FULL_TEXTS / "BSD-3-Clause.txt").read_text().split("\n", 1)[1].replace("the copyright holder", "the University")
    assert _named(f"Copyright (c) The Regents of the University of California.\nAll rights reserved.\n{text}") == "BSD-3-Clause"


def test_long_templates_inside_lines():
    prose = " ".join(f"word{k} and thing{k}" for k in range(400))
    for name in ("MIT", "ISC", "GPL-2.0", "GPL-3.0"):
        for text in (licences.HEADERS.get(name, [""])[-1], (licences.FULL_TEXTS / f"{name}.txt").read_text()):
            assert not text or _named(" ".join([prose, *text.split(), prose])) == name
    assert _named(prose) is None


def test_windows_against_every_window():
    t = licences.Templates({"X-1": ("one two three two", "five one"), "Y": ("three four five three three six",)})
    rng = np.random.default_rng(7)
    for _ in range(60):
        words = rng.choice(["one", "two", "three", "four", "five", "six", "odd", "even"], rng.integers(1, 40)).tolist()
        every = [_cosine(t, words[p : p + n], n) for n in set(t.lengths.tolist()) for p in range(len(words) - n + 1)]
        assert t.windows(words, 0.75)[0] == pytest.approx(max((c for c in every if c >= 0.75), default=0.0))


def _cosine(t, words, n):
    bag = Counter(words)
    norm = np.sqrt(sum((c * t.idf.get(w, t.unseen)) ** 2 for w, c in bag.items()))
    return max(sum(c * t.idf[w] * t.unit[t.row[w], k] for w, c in bag.items() if w in t.row) / norm for k in np.flatnonzero(t.lengths == n))


def test_inheritance(spark):
    mit, apache = "Released under the MIT License.", "Licensed under the Apache License, version 2.0."
    rows = [
        (1, "a/LICENSE", mit), (2, "a/b/x.txt", "prose"), (3, "a/b/c/COPYING.txt", apache), (4, "a/b/c/d/y.txt", None), (5, "a/b/c/z.txt", mit), (6, "e/x.txt", "prose"), (7, None, "prose"), (8, "top.txt", ""), (9, "a/b/notice.md", "nothing here"),
    ]
    out = {r["file_id"]: r for r in licences.inherited(licences.own_licences(spark.createDataFrame(rows, "file_id long, path string, text string"))).collect()}
    assert {k: r["licence"] for k, r in out.items()} == {1: "MIT", 2: "MIT", 3: "Apache-2.0", 4: "Apache-2.0", 5: "MIT", 6: None, 7: None, 8: None, 9: "MIT"}
    assert (out[2]["inherited_from"], out[2]["levels_up"]) == ("a", 2) and (out[4]["inherited_from"], out[4]["levels_up"]) == ("a/b/c", 2)
    assert out[5]["levels_up"] == 0 and out[5]["inherited_from"] is None


def test_documents(awkward, clashing, nothing):
    assert licences.scan_documents(awkward).count() == awkward.count() == licences.scan_documents(clashing).count()
    assert licences.scan_documents(nothing).count() == 0


def test_documents_climb(spark):
    """Licence files stand at the source, the language and the leaf, and the nearest counts."""
    mit, apache, bsd = "Released under the MIT License.", "Licensed under the Apache License, version 2.0.", "Licensed under the BSD 2-Clause License"
    rows = [(128, mit, "en", "web"), (64, apache, "de", "web"), (256, bsd, "de", "web"), (5, "prose", "en", "web"), (6, "prose", "de", "web"), (257, "prose", "de", "web"), (7, "prose", "en", "book"), (None, "prose", None, "web")]
    out = {r["doc_id"]: (r["licence"], r["inherited_from"], r["levels_up"]) for r in licences.scan_documents(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert out[5] == ("MIT", "web", 3) and out[6] == ("Apache-2.0", "web/de", 2) and out[257] == ("BSD-2-Clause", "web/de/1", 1)
    assert out[7] == (None, None, None) and out[128] == ("MIT", None, 0) and out[None][0] == "MIT"
