from __future__ import annotations

import random

import numpy as np

from veritab.llm import embeddings

SHAPE = "vec_id long, embedding array<float>, label int"


def brute(rows: list[tuple], cosine: float) -> dict:
    """(n_links, component) of each row number by all pairs."""
    good = [(k, i, np.array(v, dtype=np.float64)) for k, (i, v, *_) in enumerate(rows) if i is not None and v and all(c is not None and np.isfinite(c) for c in v) and any(v)]
    links = {k: 0 for k in range(len(rows))}
    root = {i: i for i, *_ in rows if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (k, i, x) in enumerate(good):
        for m, j, y in good[a + 1 :]:
            if len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= cosine:
                links[k] += 1
                links[m] += 1
                p, q = sorted((find(i), find(j)))
                root[q] = p
    return {k: (links[k], None if rows[k][0] is None else find(rows[k][0])) for k in range(len(rows))}


def cases() -> list[tuple]:
    rng = np.random.default_rng(3)
    rows = [(k, rng.standard_normal(24).tolist(), 0) for k in range(120)]
    for g in range(6):  # groups around the threshold
        centre = rng.standard_normal(24)
        rows += [(200 + 40 * g + k, (centre + rng.standard_normal(24) * (0.05 + 0.06 * g)).tolist(), 1) for k in range(25)]
    same = rng.standard_normal(24).tolist()
    rows += [(600 + k, same, 2) for k in range(30)] + [(640, [2 * c for c in same], 2)]
    rows += [(700, None, 0), (701, [0.0] * 24, 0), (702, [1.0, None] * 12, 0), (703, [float("nan")] * 24, 0), (704, [float("inf")] + [1.0] * 23, 0), (705, [], 0), (706, [1.0, 2.0], 0), (707, [1.0, 2.0], 0)]
    return rows


def test_against_all_pairs(spark):
    rows = cases()
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, SHAPE)
    exact = [(i, v if v is None else [None if c is None else float(np.float32(c)) for c in v]) for i, v, _ in rows]
    want = {rows[k][0]: r for k, r in brute(exact, 0.95).items()}
    for r in embeddings.near_vectors(df).collect():
        assert (r["n_links"], r["component_id"]) == want[r["vec_id"]], r
        assert r["kept"] == (r["vec_id"] == r["component_id"])


def test_blocks_smaller_than_a_dense_group(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 16)
    rng = np.random.default_rng(4)
    centre = rng.standard_normal(16)
    rows = [(k, (centre + rng.standard_normal(16) * 0.02).tolist(), 0) for k in range(200)]
    out = embeddings.near_vectors(spark.createDataFrame(rows, SHAPE)).collect()
    assert {(r["n_links"], r["component_id"]) for r in out} == {(199, 0)}


def test_edges(spark):
    assert embeddings.near_vectors(spark.createDataFrame([], SHAPE)).count() == 0
    rows = [(None, [1.0, 0.0], 0), (5, [1.0, 0.0], 0), (5, [1.0, 0.0], 0)]
    out = sorted((tuple(r) for r in embeddings.near_vectors(spark.createDataFrame(rows, SHAPE)).collect()), key=str)
    assert out == [(5, 1, 5, True), (5, 1, 5, True), (None, 0, None, True)]


def test_tables_grow_with_the_input():
    small, large = embeddings.tables_for(10_000, 0.95), embeddings.tables_for(10_000_000, 0.95)
    assert large[0] > small[0] and large[1] > small[1]


def test_doubles_as_they_are(spark):
    """A column of doubles is compared in its own precision."""
    a = [1.0, 0.0, 1e-9]
    rows = [(1, a), (2, [1.0, 1e-12, 1e-9]), (3, [0.0, 1.0, 0.0])]
    out = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embeddings.near_vectors(spark.createDataFrame(rows, "vec_id int, embedding array<double>")).collect()}
    assert out == {1: (1, 1), 2: (1, 1), 3: (0, 3)}
