from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from veritab.llm import spotsigs


def test_signatures_and_likeness():
    prose = "the quick fox of rivers jumps and the lazy dog in winter sleeps with the cat on mats " * 3
    a = spotsigs.signatures(prose)
    assert len(a) and spotsigs.fingerprint(a) == spotsigs.fingerprint(spotsigs.signatures(prose))
    assert (spotsigs.from_fingerprint(spotsigs.fingerprint(a)) == a).all()
    for text in ("x", "!!", "zig zag", "zig | zag | zog | zug | zeg", "the of"):
        assert len(spotsigs.signatures(text)) >= 1
    assert spotsigs.fingerprint(spotsigs.signatures("")) == spotsigs.fingerprint(spotsigs.signatures(None)) == ""
    x, y = np.array([1, 2, 3], np.uint32), np.array([2, 3, 4, 5], np.uint32)
    assert spotsigs.likeness(x, y) == 2 / 5 and spotsigs.likeness(x, y, least=0.8) == 0.0
    assert spotsigs.likeness(x[:0], x[:0]) == 1.0 and spotsigs.likeness(x, x[:0]) == 0.0


@pytest.mark.parametrize("parts", [1, 4, 9])
def test_edit_likeness_against_a_loop(spark, awkward, parts):
    """Whatever the number of ranges, each row meets the one after it."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = sorted((tuple(r) for r in spotsigs.edit_likeness(awkward).collect()), key=str)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    rows = sorted(((float("-inf") if i is None else i, t or "", i) for i, t, *_ in map(tuple, awkward.collect())), key=lambda r: r[:2])
    want = []
    for (_, text, i), (_, after, _) in zip(rows, [*rows[1:], rows[0]]):
        k = len(text) // 4
        new = text[: len(text) - k] + after[:k]
        s, e, n = (spotsigs.signatures(t) for t in (text, new, after))
        want.append((i, len(text), hashlib.sha256(new.encode()).hexdigest(), spotsigs.fingerprint(s), spotsigs.fingerprint(e), spotsigs.likeness(s, e), spotsigs.likeness(s, n)))
    assert got == sorted(want, key=str)


def test_ids_near_both_ends_of_a_long(spark):
    """Each row has its next one, whatever the size of ids."""
    top = (1 << 63) - 1
    ids = [sign * (top - 1000 * k) - (sign < 0) for k in range(30) for sign in (1, -1)] + [1 << 62, (1 << 62) + 1, 0]
    docs = spark.createDataFrame([(i, f"the big cat number {i} sat on a mat near the river {i}") for i in ids], "doc_id long, text string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 8)
    try:
        got = [r["doc_id"] for r in spotsigs.edit_likeness(docs).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted(got) == sorted(ids)


def test_edges(spark, nothing, clashing, awkward):
    assert spotsigs.edit_likeness(nothing).count() == 0
    assert spotsigs.edit_likeness(clashing).count() == awkward.count()
    lone = spark.createDataFrame([(1, "the big cat sat on a mat")], "doc_id long, text string")
    assert spotsigs.edit_likeness(lone).first()["near_next"] == 1.0


def test_similar_against_all_pairs(spark, awkward):
    links, members = spotsigs.similar(awkward, 0.5)
    sets = {}
    for r in awkward.where("doc_id is not null").collect():
        own = spotsigs.signatures(r["text"])
        key = spotsigs.fingerprint(own)
        if key not in sets or r["doc_id"] < sets[key][0]:
            sets[key] = (r["doc_id"], own)
    reps = sorted((v for k, v in sets.items() if k), key=lambda v: v[0])
    want = {(i, j): spotsigs.likeness(x, y) for a, (i, x) in enumerate(reps) for j, y in reps[a + 1 :] if spotsigs.likeness(x, y) >= 0.5}
    assert {(r["a"], r["b"]): r["likeness"] for r in links.collect()} == want and want
    assert {r["class_id"] for r in members.where("doc_id in (30, 31, 32)").collect()} == {29}


def test_all_signatures_move_once(spark, monkeypatch):
    """Counting how often a signature occurs and finding its sets are one move of the signatures, made once (F5)."""
    plans = []
    real = spotsigs.cut
    monkeypatch.setattr(spotsigs, "cut", lambda df: plans.append((df.columns, df._jdf.queryExecution().executedPlan().toString())) or real(df))
    rng = random.Random(7)
    words = [f"w{k}" for k in range(40)]
    texts = [" ".join(rng.choice(words) for _ in range(150)) for _ in range(20)]
    texts += [" ".join(w if rng.random() > 0.01 else rng.choice(words) for w in t.split()) for t in texts for _ in range(4)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = {}
    for k, t in enumerate(texts):
        sets.setdefault(spotsigs.fingerprint(spotsigs.signatures(t)), (k, spotsigs.signatures(t)))
    reps = sorted(sets.values(), key=lambda v: v[0])
    for least in (0.5, 0.8):
        want = {(i, j): spotsigs.likeness(x, y) for a, (i, x) in enumerate(reps) for j, y in reps[a + 1 :] if spotsigs.likeness(x, y) >= least}
        assert {(r["a"], r["b"]): r["likeness"] for r in spotsigs.similar(docs, least)[0].collect()} == want and len(want) > 20
    listed = [plan for columns, plan in plans if "left" in columns]
    assert len(listed) == 2 and all(plan.count("MapInArrow") == 1 and "Join" not in plan for plan in listed)
