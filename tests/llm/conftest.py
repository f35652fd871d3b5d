"""Fixtures of awkward documents."""

from __future__ import annotations

import random

import pytest

SHAPE = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def prose(rng: random.Random, n: int) -> str:
    out = []
    for _ in range(n):
        out.append(rng.choice(WORDS) + rng.choice(["", "s", "ed", "ing"]) + rng.choice(["", ",", "."]))
        if rng.random() < 0.05:
            out.append("\n")
    return " ".join(out)


def awkward_rows(seed: int = 5) -> list[tuple]:
    """Nulls, empty and long texts, exact and near copies, repeated rows and lines, odd spaces."""
    rng = random.Random(seed)
    rows = []
    for k in range(60):
        rows.append([k, prose(rng, rng.randint(3, 120)), "en", f"src{k % 3}"])
    rows[3][1], rows[4][1], rows[5][1], rows[6][1] = None, "", " \n\t", "\x1fone\x0btwo"
    rows[7][1] = prose(rng, 9000)
    shared = "This is one shared line of more than twenty signs."
    for k in (10, 11, 12, 13):
        rows[k][1] = f"{prose(rng, 20)}\n  {shared.upper()}\t\n{prose(rng, 10)}"
    base = prose(rng, 200)
    for k in (20, 21, 22):
        words = base.split(" ")
        for _ in range(k - 20):
            words[rng.randrange(len(words))] = "changed"
        rows[k][1] = " ".join(words)
    for k in (30, 31, 32):
        rows[k][1] = rows[29][1]
    rows[40][3] = None
    rows[41][2] = None
    out = [(a, t, lang, s, None if t is None else len(t)) for a, t, lang, s in rows]
    return [*out, out[20], out[20], (None, "a row without an id but with some words", "en", "src0", 39)]


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SHAPE)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SHAPE)


@pytest.fixture(scope="session")
def clashing(awkward):
    """The same rows with more columns, whose names operators use inside."""
    from pyspark.sql import functions as F

    names = ["id", "keys", "_id", "_keys", "band", "component_id", "kept", "epoch", "block", "tokens", "row", "Unit", "size", "odd.name"]
    return awkward.select("*", *[F.lit(1).alias(n) for n in names])
