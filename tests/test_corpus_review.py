from __future__ import annotations

import difflib
import random

import pytest
from pyspark.sql import functions as F

from veritab.operators import accounting, corpus, graph, merge, order, review, spans
from veritab.operators.selection import apply_verdicts, select_for_judging
from veritab.operators.gate import FIELD, Policy

SHAPE = "ord long, doi string, pmid string, pmcid string, arxiv string, nct string, s2 string, openalex string, id string, title string, authors array<string>, year int"


def papers(spark, rows):
    full = [{**dict.fromkeys(c.split()[0] for c in SHAPE.split(", ")), "ord": k, "id": f"p{k}", **r} for k, r in enumerate(rows)]
    names = [c.split()[0] for c in SHAPE.split(", ")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in full], SHAPE)


def test_registry_is_sequential(spark):
    """A duplicate registers nothing: its other identifiers don't become keys."""
    rows = [{"doi": "10.1/A"}, {"doi": "https://doi.org/10.1/a", "pmid": "7"}, {"pmid": "7"}, {"pmid": "7", "s2": "x"}, {"s2": "x"}, {"s2": "x"}]
    got = {r["ord"]: (r["verdict"], r["match"]) for r in corpus.dedupe_identifiers(papers(spark, rows)).collect()}
    assert got == {0: ("new", None), 1: ("doi", "10.1/a"), 2: ("new", None), 3: ("pmid", "7"), 4: ("new", None), 5: ("source_id", "p4")}


def test_fuzzy_titles_and_corrections(spark):
    rows = [
        {"title": "A study of mice and men in the old town"}, {"title": "A study of mice and men in the old towns", "year": 2020}, {"title": "Erratum: A study of mice and men in the old town"},
        {"title": "Correction to something else entirely that nobody has seen"}, {"title": "Quite different"},
    ]
    got = {r["ord"]: r for r in corpus.dedupe(papers(spark, rows)).collect()}
    assert [got[k]["verdict"] for k in range(5)] == ["new", "fuzzy_flagged", "correction_of", "correction_of", "new"]
    assert got[1]["match"] == "p0" and got[1]["needs_review"] and not got[1]["is_duplicate"] and got[3]["match"] is None


def test_title_blocking_is_lossless(spark):
    rng = random.Random(2)
    base = ["effect of light on growth", "deep learning for protein folding", "a survey of surveys", "soil carbon in wet forests"]
    titles = []
    for _ in range(60):
        t = list(rng.choice(base))
        for _ in range(rng.randint(0, 4)):
            t[rng.randrange(len(t))] = rng.choice("abcdefgh ")
        titles.append("".join(t))
    key = lambda t: " ".join(t.split())
    want = {(j, i): difflib.SequenceMatcher(None, key(titles[j]), key(titles[i])).ratio() for j in range(60) for i in range(j)}
    want = {k: v for k, v in want.items() if v >= 0.88}
    got = {(r["ord"], r["other_ord"]): r["ratio"] for r in corpus.title_pairs(papers(spark, [{"title": t} for t in titles])).collect() if r["ratio"] >= 0.88}
    assert got == pytest.approx(want) and want


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(k, k + 1) for k in range(300, 340)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        p, q = sorted((find(a), find(b)))
        root[q] = p
    want = {x: find(x) for x in root if any(x in e and e[0] != e[1] for e in edges)}
    got = {r["node"]: r["component"] for r in graph.connected(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == want


def test_screen(spark):
    def run(text, **k):
        return spark.range(1).select(corpus.screen(F.lit(text).cast("string"), **k).alias("s")).first()["s"]

    assert run("Two enzymes.", require_any=["enzyme"])["verdict"] == "present"
    assert run("co-enzymeX", require_any=["enzyme"])["verdict"] == "uncertain"
    assert run("enzyme and review", require_any=["enzyme"], exclude_any=["review"])["verdict"] == "excluded"
    assert run("nothing", require_any=["enzyme"], full_text=True)["verdict"] == "absent"
    assert run("nothing")["verdict"] == "uncertain" and run("")["scope"] == "empty"
    assert run("x" * 3001 + " enzyme", require_any=["enzyme"])["verdict"] == "uncertain"
    assert run("a b", require_all=["a", "b"])["verdict"] == "present" and run("a", require_all=["a", "b"], full_text=True)["verdict"] == "absent"
    hit = run("An  enzyme", require_any=["enzyme"])["matched"][0]
    assert (hit["offset"], hit["quote"]) == (4, "enzyme")


def test_spans(spark):
    df = spark.createDataFrame([("aa", "aaaa"), ("é😀", "xé😀é😀"), ("", "abc"), ("z", None)], "q string, t string")
    got = [r["s"] for r in df.select(spans.find_spans(F.col("q"), F.col("t")).alias("s")).collect()]
    assert got[:3] == [[0, 1, 2], [1, 3], []] and not got[3]
    many = spark.range(1).select(spans.find_spans(F.lit("a"), F.lit("a" * 80)).alias("s")).first()["s"]
    assert many == list(range(50))
    state = lambda q, o, t: spark.range(1).select(spans.anchor_state(F.lit(q), F.lit(o), F.lit(t).cast("string")).alias("s")).first()["s"]
    assert state("bc", 1, "abcbc")["state"] == "exact"
    assert tuple(state("bc", 2, "abcxxbc")) == ("moved", 1)
    assert state("zz", 1, "abc")["state"] == "absent" and state("zz", 9, "abc")["state"] == "past_end" and state("a", 0, None)["state"] == "no_store"
    assert spark.range(1).select(spans.worst_state(F.array(F.lit("exact"), F.lit("absent"), F.lit("moved"))).alias("s")).first()["s"] == "absent"
    sections = spark.createDataFrame([("s", "A", 0, 10, 0, 0), ("s", "B", 2, 6, 1, 1), ("s", "C", 2, 6, 1, 2)], "source_id string, title string, start int, end int, depth int, ord int")
    offs = spark.createDataFrame([("s", 1), ("s", 3), ("s", 10), ("t", 0)], "source_id string, offset int")
    assert {(r["source_id"], r["offset"]): r["section"] for r in spans.innermost_section(offs, sections).collect()} == {("s", 1): "A", ("s", 3): "B", ("s", 10): None, ("t", 0): None}


def test_identity_is_independent_of_order(spark):
    rows = [("s", p, r, "e", a, b, f"r{r}") for p in range(2) for r, (a, b) in enumerate([("x", "1"), (None, "2"), (None, None), (None, "2")])]
    shape = "source_id string, pass_ix int, rec_ix int, entity_type string, a string, b string, record_id string"
    ident = merge.Identity.of({"chain": ["a"], "ordinal_within": "b"})
    values = {"a": F.col("a"), "b": F.col("b")}
    one = merge.with_identity(spark.createDataFrame(rows, shape), ident, values)
    got = {(r["pass_ix"], r["rec_ix"]): (r["identity"], r["identity_tier"]) for r in one.collect()}
    assert got[0, 0] == ("x", "primary") and got[0, 1] == ("2#ord0", "ordinal") and got[0, 3] == ("2#ord1", "ordinal") and got[0, 2] == ("#ord0", "ordinal_unscoped")
    random.Random(1).shuffle(rows)
    two = merge.with_identity(spark.createDataFrame(rows, shape), ident, values)
    assert {(r["pass_ix"], r["rec_ix"]): (r["identity"], r["identity_tier"]) for r in two.collect()} == got
    bare = merge.with_identity(spark.createDataFrame(rows, shape), merge.Identity.of("a"), values)
    assert {r["rec_ix"] for r in bare.where("identity_error").collect()} == {1, 2, 3}


def test_upserts(spark):
    new = spark.createDataFrame([("k", "a", 1), ("k", "b", 2), ("k", "a", 3), ("m", "z", 1)], "record_id string, payload string, seq long")
    held = spark.createDataFrame([("m", "y")], "record_id string, payload string")
    got = {(r["record_id"], r["seq"]): r["outcome"] for r in review.resolve_upserts(new, held).collect()}
    assert got == {("k", 1): "written", ("k", 2): "collision", ("k", 3): "identical", ("m", 1): "collision"}


def test_selection_and_verdicts(spark):
    rows = [(f"r{k}", 1.0 if k < 3 else 0.1, None, [], k) for k in range(40)] + [("r0", 1.0, None, [], 99)]
    scored = spark.createDataFrame(rows, f"record_id string, composite double, route string, fields array<{FIELD}>, seq long")
    field = F.array(F.from_json(F.lit('{"field_name": "f", "has_provenance": true, "contradiction_search": "clean", "n_contradictions": 0}'), FIELD[7:-1].replace(":", " ")))
    out = select_for_judging(scored.withColumn("fields", field), Policy(), 0.1, "salt")
    n = {r["state"]: r["n"] for r in out.groupBy("state").agg(F.count("*").alias("n")).collect()}
    assert n == {"selected": 3, "audit": 4, "rejected": 33}
    verdicts = spark.createDataFrame([("r0", "supported", "x" * 500)], "record_id string, verdict string, note string")
    told = {r["record_id"]: (r["judge_verdict"], len(r["judge_note"] or "")) for r in apply_verdicts(out, verdicts).collect()}
    assert told["r0"] == ("supported", 400) and told["r1"] == ("unparseable", 0)
    assert sum(v == ("not_run", 0) for v in told.values()) == 33


@pytest.mark.parametrize("anchors", [20_000, 0])
def test_quotes_against_all_texts(spark, monkeypatch, anchors):
    """Also where anchors are joined, and for quotes without an inner word."""
    monkeypatch.setattr(spans, "FEW", anchors)
    texts = [("a", "the old cat sat on the mat"), ("b", "an older cat sat"), ("c", None), ("d", "")]
    quotes = [(1, "old cat sat"), (2, "cat"), (3, "ld cat sa"), (4, "cat sat"), (5, ""), (6, "no such thing here")]
    want = {(i, q, t.find(p)) for i, t in texts for q, p in quotes if t and p and p in t}
    found = spans.quotes_in_texts(spark.createDataFrame(texts, "source_id string, text string"), spark.createDataFrame(quotes, "quote_id int, quote string"))
    assert {tuple(r) for r in found.collect()} == want
    own = spans.quotes_in_texts(spark.createDataFrame(texts, "source_id string, text string"), spark.createDataFrame([("a", 1, "cat"), ("b", 2, "mat")], "source_id string, quote_id int, quote string"), "source_id")
    assert [tuple(r) for r in own.collect()] == [("a", 1, 8)]


def test_running_sums_and_ranks_over_ranges(spark):
    rng = random.Random(9)
    rows = [(k, rng.choice(["a", "b", None]), rng.randrange(1000), rng.choice([None, 1, 5])) for k in range(500)]
    df = spark.createDataFrame(rows, "id int, g string, x int, v int").repartition(7)
    total, want = 0, {}
    for k, (i, _, x, v) in enumerate(sorted(rows, key=lambda r: (-r[2], r[0]))):
        total += v or 0
        want[i] = (total, k + 1)
    got = order.running(df, [F.col("x").desc(), F.col("id")], {"t": F.col("v"), "n": F.lit(1)})
    assert {r["id"]: (r["t"], r["n"]) for r in got.collect()} == want
    sizes = {g: sum(r[1] == g for r in rows) for g in ("a", "b", None)}
    ranks = order.ranked_within(df, ["g"], [F.col("x"), F.col("id")]).collect()
    for g in sizes:
        own = sorted((r for r in ranks if r["g"] == g), key=lambda r: r["_n"])
        assert [r["_n"] for r in own] == list(range(1, sizes[g] + 1)) and {r["_of"] for r in own} == {sizes[g]}
        assert [(r["x"], r["id"]) for r in own] == sorted((r["x"], r["id"]) for r in own)
    usage = df.selectExpr("id", "x AS input", "0 AS output", "0 AS cache_read", "0 AS cache_write")
    tripped = accounting.fuse(usage, ["id"], 10_000, 50_000).where("first_trip").collect()
    assert len(tripped) == 1 and tripped[0]["tokens"] > 50_000
