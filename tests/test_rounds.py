"""Operators written in rounds, stretches or unrolled columns give what their plain forms give."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from veritab.functions import text as tx
from veritab.functions.once import apart
from veritab.operators import accounting, agreement, corpus, review, sets, spans, uncertainty
from veritab.sources import search
from veritab.sources.tables import OutputTables

IDS = ("doi", "pmid", *corpus.IDENTIFIERS)


def replay(rows: list[dict]) -> dict[int, tuple]:
    """Papers registered one after another."""
    seen, out = {}, {}
    for r in sorted(rows, key=lambda r: r["ord"]):
        ids = [(k, r[k]) for k in IDS if r.get(k)]
        hit = next(((k, seen[k, v]) for k, v in ids if (k, v) in seen), None)
        if hit:
            out[r["ord"]] = (hit[0] if hit[0] in ("doi", "pmid") else "source_id", hit[1], False)
        else:
            seen |= dict.fromkeys(ids, f"p{r['ord']}")
            out[r["ord"]] = ("new", None, True)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_rounds_of_identifiers(spark, seed):
    """Chains, hubs and identifiers that clash, in any order of the rows."""
    rng = random.Random(seed)
    rows = [{"ord": k} | {c: rng.choice([None, None, "hub", f"{c}{rng.randrange(25)}"]) for c in ("pmid", "arxiv", "s2")} for k in range(120)]
    rows += [{"ord": 200 + k, "nct": f"n{k // 2}", "openalex": f"o{(k + 1) // 2}"} for k in range(12)]  # a chain
    shape = "ord long, doi string, pmid string, pmcid string, arxiv string, nct string, s2 string, openalex string, id string"
    names = [c.split()[0] for c in shape.split(", ")]
    shuffled = rng.sample(rows, len(rows))
    df = spark.createDataFrame([tuple(r.get(n) if n != "id" else f"p{r['ord']}" for n in names) for r in shuffled], shape)
    want = replay(rows)
    got = {r["ord"]: (r["verdict"], r["match"], r["registered"]) for r in corpus.dedupe_identifiers(df).collect()}
    # a paper's key is its pmid where it has one: only which paper is matched is compared there
    keys = {f"p{r['ord']}": r.get("pmid") or f"p{r['ord']}" for r in rows}
    assert got == {k: (v, None if m is None else keys[m], ok) for k, (v, m, ok) in want.items()}


def test_no_identifier_is_shared(spark):
    shape = "ord long, doi string, pmid string, pmcid string, arxiv string, nct string, s2 string, openalex string, id string"
    none = [None] * 6
    df = spark.createDataFrame([(1, "10.1/a", *none, "x"), (2, None, *none, None)], shape)
    assert {(r["ord"], r["verdict"], r["paper_key"]) for r in corpus.dedupe_identifiers(df).collect()} == {(1, "new", "10.1/a"), (2, "new", "anon2")}
    assert corpus.dedupe_identifiers(df.where("false")).count() == 0


def test_unrolled_agreement(spark):
    rng = random.Random(4)
    pool = ["10", "10.05", "10.2", "ten", "Ten", None, "7", "x-1", "-3"]
    rows = [tuple([k] + [rng.choice(pool) for _ in range(4)]) for k in range(300)] + [(900, None, None, None, None)]
    df = spark.createDataFrame(rows, "k int, a string, b string, c string, d string")
    for passes in (["a"], ["a", "b"], ["a", "b", "c"], ["a", "b", "c", "d"]):
        made = df.select("k", *[agreement.comparable(F.col(p)).alias(p) for p in passes])
        plain = {r["k"]: r["x"] for r in made.select("k", agreement.agreement(F.array(*passes)).alias("x")).collect()}
        ours = {r["k"]: r["x"] for r in agreement.with_agreement(made, passes, "x").select("k", "x").collect()}
        assert ours == plain
    numbers = spark.createDataFrame([(1.0, 2.0, 3.0), (0.0, 0.0, 0.0), (1.0, None, 2.0), (-1.0, 1.0, 0.0), (5.0, 5.0, 5.0)], "a double, b double, c double")
    both = numbers.select(agreement.consistency(F.array("a", "b", "c")).alias("x"), agreement.consistency_of([F.col(c) for c in "abc"]).alias("y")).collect()
    assert [r["x"] for r in both] == pytest.approx([r["y"] for r in both]) and both[2]["y"] is None


def test_uncertainty_as_columns(spark):
    rng = random.Random(6)
    pool = [None, "sd", "ci", "not reported", "0", "12", "-1", "3-5", "x", "99", "range", "100"]
    roles = {r: f"m_{r}" for r in uncertainty.ROLES}
    names = ["m", *roles.values(), "n", "n_spread"]
    df = spark.createDataFrame([(k, *[rng.choice(pool) for _ in names]) for k in range(400)], "k int, " + ", ".join(f"{n} string" for n in names))
    groups, values = {"m": roles, "n": {"spread": "n_spread"}}, {n: F.col(n) for n in names}
    plain = {r["k"]: sorted(tuple(x) for x in r["w"]) for r in df.select("k", uncertainty.uncertainty_reasons(values, groups).alias("w")).collect()}
    out = uncertainty.with_uncertainty(df, values, groups, "w").collect()
    assert {r["k"]: sorted(tuple(x) for x in r["w"]) for r in out} == plain and any(plain.values())
    assert all((r["w_codes"] or "") == ",".join(sorted(x["code"] for x in r["w"])) for r in out)
    assert df.select(apart(F.lit(1), F.col("m")).alias("x")).distinct().count() == 1


def test_offsets_meet_ranges_by_stretches(spark, monkeypatch):
    monkeypatch.setattr(spans, "STRETCH", 7)
    rng = random.Random(8)
    sections = [(s, k, f"t{k}", a, a + rng.randint(0, 60), rng.randint(0, 3)) for s in "ab" for k in range(30) for a in [rng.randint(0, 200)]]
    offsets = [(rng.choice("abc"), rng.randint(0, 260), k) for k in range(150)]

    def brute(s: str, o: int):
        inside = [(-d, k, t) for x, k, t, a, b, d in sections if x == s and a <= o < b]
        return min(inside)[2] if inside else None

    out = spans.innermost_section(spark.createDataFrame(offsets, "source_id string, offset int, row int"), spark.createDataFrame(sections, "source_id string, ord int, title string, start int, end int, depth int")).collect()
    assert {r["row"]: r["section"] for r in out} == {k: brute(s, o) for s, o, k in offsets}


def test_quotes_with_and_without_an_inner_word(spark):
    texts = spark.createDataFrame([("a", "one two three four"), ("b", "stone two threes"), ("c", "nothing")], "source_id string, text string")
    quotes = spark.createDataFrame([(1, "one two three"), (2, "two thr"), (3, "th"), (4, "")], "quote_id int, quote string")
    got = sorted(tuple(r) for r in spans.quotes_in_texts(texts, quotes).collect())
    assert got == [("a", 1, 0), ("a", 2, 4), ("a", 3, 8), ("b", 1, 2), ("b", 2, 6), ("b", 3, 10), ("c", 3, 2)]


def test_what_may_be_written(spark, tmp_path):
    field = "array<struct<field_name:string,value:string,source_id:string>>"
    rows = [
        ("r", "S", True, [("x", "1", "S"), ("note", "prose", "S")]), ("S:r", "S", True, [("x", "2", "S")]), ("only", "S", True, [("note", "prose", "S")]), ("both", "S", True, [("x", "1", "S"), ("y", "1", "T")]),
        ("no", "S", False, [("x", "1", "S")]), ("lost", None, True, [("x", "1", None)]), ("bare", "S", None, [("x", "1", None)]),
    ]
    gated = spark.createDataFrame(rows, f"record_id string, source_id string, allowed boolean, fields {field}")
    gated = gated.withColumns({"entity_type": F.lit("e"), "route": F.lit("auto_accept"), "source_status": F.lit("active"), "composite": F.lit(1.0), "written_at": F.lit("t"), "seq": F.monotonically_increasing_id()})
    tables = OutputTables(spark, str(tmp_path / "t"))
    for again in (False, True):
        out = {r["record_id"]: (r["outcome"], r["refused"]) for r in tables.upsert(gated, ("note",)).collect()}
        said = "identical" if again else "written"
        assert out == {"S:r": (said, None), "S:S:r": (said, None), "S:only": ("denied", "every_field_in_lane"), "S:both": ("denied", "several_sources"), "S:no": ("denied", "gate"), "lost": ("denied", "no_source"), "S:bare": ("denied", "gate")}
    held = {r["record_id"]: r["payload"] for r in tables.records().collect()}
    assert set(held) == {"S:r", "S:S:r"} and "prose" not in held["S:r"]


def test_rulings_are_trimmed_and_lower_cased(spark):
    rows = spark.createDataFrame([(" Right",), ("WRONG ",), ("maybe",), (None,)], "verdict string")
    assert [r[0] for r in rows.select(review.ruling(F.col("verdict"))).collect()] == ["right", "wrong", None, None]


def test_ceilings_from_the_environment():
    fuse = accounting.Fuse.from_environment({"VERITAB_MAX_CALLS": "3", "VERITAB_MAX_TOKENS": "-1"}, tokens=10)
    assert (fuse.max_calls, fuse.max_tokens) == (3, 10)
    fuse.raise_ceiling("calls", 4)
    with pytest.raises(ValueError):
        fuse.raise_ceiling("calls", 4)
    with pytest.raises(accounting.FuseExceeded):
        fuse.record(11)


def test_saved_hits_keep_their_order(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"part{k}.txt").write_text("".join(f'{{"n": {k * 10 + j}}}\n' for j in range(10)))
    got = search.saved_search(spark, str(tmp_path)).orderBy("ord").collect()
    assert [r["ord"] for r in got] == list(range(30)) and [r["value"] for r in got] == [f'{{"n": {k}}}' for k in range(30)]


def test_set_operations_refuse_other_columns(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (None, "y")], "k int, v string")
    assert sets.combine(a, a.select("v", "k"), "intersect_all").count() == 3
    with pytest.raises(ValueError):
        sets.combine(a, a.drop("v"), "union")
    with pytest.raises(ValueError):
        sets.combine(a, a, "minus")


def test_compatible_forms(spark):
    rows = spark.createDataFrame([("plain",), ("ｆｕｌｌ ﬁ",), (None,), ("",)], "t string")
    assert [r[0] for r in rows.select(tx.compatible(F.col("t"))).collect()] == ["plain", "full fi", None, ""]
