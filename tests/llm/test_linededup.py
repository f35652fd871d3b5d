from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest

from veritab.llm import linededup

BLANK = " \t\n\x0b\x0c\r"


def key_of(line: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(BLANK))


def brute(rows: list[tuple], min_docs: int = 3, min_chars: int = 20) -> list[tuple]:
    """(doc_id, lines, dropped, kept text) by a table of all keys."""
    holders = defaultdict(list)
    for i, t, *_ in rows:
        for key in {key_of(line) for line in (t or "").split("\n")}:
            if len(key) >= min_chars:
                holders[key].append(float("-inf") if i is None else i)
    out = []
    for i, t, *_ in rows:
        own = float("-inf") if i is None else i
        lines = (t or "").split("\n")
        stay = [x for x in lines if len(h := holders.get(key_of(x), [])) < min_docs or max(h) == own]
        out.append((i, len(lines), len(lines) - len(stay), hashlib.sha256("\n".join(stay).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("bits", [1 << 24, 1 << 6])
def test_against_brute_force(awkward, bits):
    """Also with filters so small that everything is suspected."""
    rows = [tuple(r) for r in awkward.collect()]
    got = sorted((tuple(r) for r in linededup.line_digests(awkward, bits=bits).collect()), key=str)
    assert got == brute(rows)
    assert any(r[2] for r in got)


def test_unicode_length_and_largest_id(spark):
    short, long = "é" * 19, "é" * 20
    rows = [(k, f"{short}\n{long}\n x") for k in (5, 9, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["n_dropped"] for r in linededup.line_digests(docs).collect()}
    assert got == {5: 1, 7: 1, 9: 0}


def test_stage_keeps_rows_and_columns(nothing, clashing):
    assert linededup.line_digests(nothing).count() == 0
    out = linededup.drop_repeated_lines(clashing)
    assert out.columns == clashing.columns and out.count() == clashing.count()
    for r in out.collect():
        assert r["text"] is None or r["n_chars"] == len(r["text"])
    assert linededup.drop_repeated_lines(nothing).count() == 0


def test_filters_of_ranges_suspect_few(spark, tmp_path):
    """Keys that one filter can't tell apart are cut into ranges: what is suspected stays close to what repeats."""
    once = [(k, "\n".join(f"a line that stands in one document only {k} {i}" for i in range(40))) for k in range(100)]
    often = [(1000 + k, "\n".join(f"a line that stands in several documents {i}" for i in range(10))) for k in range(5)]
    docs = spark.createDataFrame(once + often, "doc_id long, text string").repartition(3)
    rows = linededup.cut(linededup._marked(docs).mapInArrow(linededup._row_keys(20), "k1 long, k2 long, id long, mark long"))
    for bits in (1 << 16, 1 << 10):
        _, counts = linededup.suspected(rows, 4010, bits)
        got = counts.collect()
        assert sum(r["n"] >= 3 for r in got) == 10
        assert len(got) < 0.2 * 4010, bits


def test_rows_without_an_id_lose_their_own_lines_only(spark):
    """Many rows share the null id; decisions are gathered by id and text."""
    rows = [(None, f"a line that stands in all of the documents\nown {k}") for k in range(6)] + [(1, "a line that stands in all of the documents")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in linededup.line_digests(docs).collect()), key=str)
    assert got == brute(rows)


def test_emptied_rows_may_go(spark):
    shared = "one line that is found in every one of them"
    rows = [(k, shared, 1) for k in (1, 2, 3)] + [(4, None, 0), (5, "", 0), (6, " \n", 2), (7, shared + "\nand more", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    left = {r["doc_id"]: r["text"] for r in linededup.drop_repeated_lines(docs, drop_emptied=True).collect()}
    assert left == {4: None, 5: "", 6: " \n", 7: shared + "\nand more"}
    assert linededup.drop_repeated_lines(docs).count() == len(rows)
