from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from veritab.llm import packing
from veritab.llm.tokens import WordTokens

PATH = packing.vocabulary_path()


def check_plan(counts: np.ndarray, room: int) -> int:
    rows, n = packing.plan_packing(counts, room)
    seqs, used = defaultdict(list), np.zeros_like(counts)
    for length, lo, k, first, offset in rows:
        used[length] += k
        for i in range(k):
            seqs[first + i].append((offset, length))
    assert (used == counts).all() and len(seqs) == n
    for places in seqs.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= room
    return n


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 24), max_size=80))
def test_plan_places_everything_once(lengths):
    n = check_plan(np.bincount(lengths, minlength=25), 24)
    assert n >= -(-sum(lengths) // 24)


def test_plan_finds_exact_complements():
    counts = np.zeros(101, dtype=np.int64)
    counts[[60, 40, 50, 30, 20, 10, 35, 45]] = [5, 5, 4, 2, 2, 4, 1, 1]
    total = int((counts * np.arange(101)).sum())
    assert check_plan(counts, 100) == -(-total // 100)
    assert packing.plan_packing(np.zeros(101, dtype=np.int64), 100) == ([], 0)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_ids_are_the_library_s(library):
    texts = ["It's a TEST, isn't it? 12½ x²", "", " ", "İstanbul Σς 中文 \x1c \x85", "don't'll ''s $%% a|b", "ÀÉî ŉ ǅ — …€", "a" * 300, "\U0001f600 ok"]
    own = WordTokens(PATH, cached=3)
    for _ in range(2):
        for got, t in zip(own.ids(texts), texts):
            assert got == np.array(library.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes(), t


def test_ids_of_every_character(library):
    """Each code point of the range that isn't left to the library, alone and inside and between words."""
    texts = [t for c in map(chr, range(1, 0x250)) for t in (c, f"a{c}b {c}liyev {c}{c} 1{c}2")]
    wrong = [t for got, t in zip(WordTokens(PATH).ids(texts), texts) if got != np.array(library.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes()]
    assert not wrong


def test_strings_of_special_tokens(library):
    """The plain call of the library makes one id of such a string."""
    texts = ["a <|endoftext|> b", "<|startoftext|>x<|endoftext|>", "A <|EndOfText|> b", "no <| endoftext |> here"]
    for got, t in zip(WordTokens(PATH).ids(texts), texts):
        assert got == np.array(library.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes(), t


def test_round_trip(awkward, library):
    rows = [tuple(r) for r in awkward.collect()]
    out = packing.pack(awkward).collect()
    want = defaultdict(int)
    for i, t, *_ in rows:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        for k, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at : at + 2048]
            want[i, k, at, len(part), zlib.crc32(np.array(part, dtype="<u4").tobytes())] += 1
    got = defaultdict(int)
    seqs = defaultdict(list)
    for r in out:
        got[r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]] += 1
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
    assert got == want
    for places in seqs.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048


def test_empty(nothing, clashing, awkward):
    assert packing.pack(nothing).count() == 0
    assert packing.pack(clashing).count() == packing.pack(awkward).count()
