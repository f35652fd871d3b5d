from __future__ import annotations

import numpy as np

from veritab.llm import minhash
from veritab.llm.hashing import ascii_words, fast_sketch, shingle_set


def shingles(text: str | None) -> set[tuple]:
    words = ascii_words(text)
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows: list[tuple], percent: int) -> dict:
    """Component of each id by comparing all pairs of sets; rows that share an id are linked."""
    sets = [(i, shingles(t)) for i, t, *_ in rows if i is not None]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (i, x) in enumerate(sets):
        for j, y in sets[a + 1 :]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = sorted((find(i), find(j)))
                root[q] = p
    return {i: find(i) for i in root}


def test_against_all_pairs(spark, awkward):
    rows = [tuple(r) for r in awkward.collect()]
    for percent in (80, 85):
        want = brute(rows, percent)
        got = minhash.near_duplicates(awkward, percent).collect()
        assert len(got) == len(rows)
        for r in got:
            if r["doc_id"] is None:
                assert r["component_id"] is None and r["kept"]
            else:
                assert r["component_id"] == want[r["doc_id"]]
                assert r["kept"] == (r["component_id"] == r["doc_id"])
        sizes = {r["doc_id"]: r["n_shingles"] for r in got}
        assert all(sizes[i] == len(shingles(t)) for i, t, *_ in rows)
        assert sizes[3] == sizes[4] == sizes[5] == 0 and sizes[6] == 1


def test_a_hot_group_of_near_copies(spark, monkeypatch):
    """Hundreds of copies, each edited at its own place, in blocks far smaller than their buckets."""
    monkeypatch.setattr(minhash, "BLOCK", 16)
    monkeypatch.setattr(minhash, "TILE", 5)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for k in range(150):
        words = list(base)
        words[k % 120] = f"edit{k}"
        rows.append((k, " ".join(words)))
    rows += [(1000 + k, " ".join(f"v{k}_{i}" for i in range(40))) for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows, 85)
    assert {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs, 85).collect()} == want


def test_empty_and_clashing(spark, nothing, clashing, awkward):
    assert minhash.near_duplicates(nothing).count() == 0
    plain = {tuple(r) for r in minhash.near_duplicates(awkward).collect()}
    assert {tuple(r) for r in minhash.near_duplicates(clashing).collect()} == plain
    left = minhash.drop_near_duplicates(clashing)
    assert left.columns == clashing.columns
    ids = [r["doc_id"] for r in left.collect()]
    kept = {r["doc_id"] for r in minhash.near_duplicates(awkward).where("kept").collect()}
    assert sorted(i for i in ids if i is not None) == sorted(i for i in kept if i is not None) and None in ids


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(1)
    common, a, b = (rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (900, 50, 50))
    x, y = np.concatenate([common, a]), np.concatenate([common, b])
    sk = fast_sketch(np.concatenate([x, y]), np.array([950, 950]), 512)
    assert abs((sk[0] == sk[1]).mean() - 0.9) < 0.05
    tiny = fast_sketch(np.array([7], np.uint64), np.array([1]), 64)
    assert (tiny != np.uint64(0xFFFFFFFFFFFFFFFF)).all()  # one element fills every coordinate
    assert len(shingle_set(ascii_words("a b c d e a b c d e"))) == 5


def test_more_ids_than_a_filter_holds(spark, monkeypatch, awkward):
    """Then ids and texts are joined by shuffle; the result is the same."""
    want = {tuple(r) for r in minhash.near_duplicates(awkward, 80).collect()}
    monkeypatch.setattr(minhash, "ID_FILTER_BITS", 1)
    assert {tuple(r) for r in minhash.near_duplicates(awkward, 80).collect()} == want


def test_of_rows_that_share_an_id_the_least_text_stays(spark):
    rows = [(1, "one text of its own here", "x"), (1, "another text that is longer than it", "y"), (2, "words that nobody else has written", "z"), (3, None, "u"), (3, "a text beside a null one", "v")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, `odd.name` string")
    left = sorted(tuple(r) for r in minhash.drop_near_duplicates(docs).collect())
    assert left == [(1, "another text that is longer than it", "y"), (2, "words that nobody else has written", "z"), (3, None, "u")]


def test_low_thresholds_keep_the_miss_rate():
    for percent in (5, 20, 50, 80, 85):
        bands, rows = minhash.banding(percent)
        assert (1 - (percent / 100) ** rows) ** bands <= minhash.MISS * 1.001
