from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from veritab.operators.accounting import Fuse, FuseExceeded
from veritab.plans import spec as sp
from veritab.sources import artifacts, pages, sidecar, stores
from veritab.sources.tables import OutputTables
from veritab.streaming import ingest

def tag(name: str, *parts: str) -> str:
    return f"<{name}>{''.join(parts)}</{name.split()[0]}>"


FRONT = tag("front", tag("article-meta", tag("title-group", tag("article-title", "On ", tag("i", "mice"))), tag("abstract", tag("p", "Short."))))
TABLE = tag("table-wrap", tag("label", "Table 1"), tag("caption", tag("p", "Values")), tag("table", tag("tr", tag("th", "a"), "<th/>"), tag("tr", tag("td", "1"), tag("td", "2"))))
BODY = tag("body", tag("sec", tag("title", "Results"), tag("p", "One  ", tag("b", "two"), "\nthree."), tag("sec", tag("title", "Inner"), tag("p", "Deep.")), TABLE))
ARTICLE = tag('article xmlns="urn:a"', FRONT, "\n", BODY, "\n", tag("back", tag("app", tag("p", "Extra.")), tag("ref-list", tag("ref", "Never"))))



def test_xml_store():
    s = stores.xml_store("x", ARTICLE)
    assert s["full_text"] == "On mice\n\nShort.\n\nResults\n\nOne two three.\n\nInner\n\nDeep.\n\nTable 1 Values\n\na\n\n1\t2\n\nExtra.\n\n"
    titles = [(x["title"], x["depth"]) for x in s["sections"]]
    assert titles == [("Abstract", 0), ("Results", 0), ("Inner", 1)]
    inner = s["sections"][2]
    assert s["full_text"][inner["start"] : inner["end"]] == "Inner\n\nDeep.\n\n"
    with pytest.raises(ValueError):
        stores.xml_store("x", "<article><body/></article>")


def test_xml_errors_are_rows(spark):
    got = stores.xml_stores(spark.createDataFrame([("a", ARTICLE), ("b", "<broken"), ("c", None)], "source_id string, xml string")).collect()
    assert [r["error"] is None for r in sorted(got, key=lambda r: r["source_id"])] == [True, False, False]


def wrap(body: str, notes: str) -> str:
    return f"<a><table-wrap><table>{body}</table>{notes}</table-wrap></a>"


def test_sidecar_spans_and_markers():
    head = '<tr><th rowspan="2">Name</th><th colspan="2">V</th></tr>' + tag("tr", tag("th", "x"), tag("th", "y"))
    body = head + tag("tr", *(tag("td", x) for x in ("P. aeruginosa", "12.4a", "4a"))) + '<tr><td rowspan="all">n<xref rid="f1">a</xref></td>' + tag("td", "5 a") + tag("td", "7*") + "</tr>"
    (cells, notes), = sidecar.parse_tables(wrap(body, '<fn id="f1"><label>a</label><p>mean</p></fn><fn><p>* significant</p></fn>'))
    at = {(c.row, c.col): c for c in cells}
    assert (at[1, 1].text, at[1, 2].text) == ("x", "y") and at[0, 1].colspan == 2
    assert [(at[k].value_text, at[k].marker_source) for k in ((2, 0), (2, 1), (2, 2), (3, 0), (3, 1), (3, 2))] == [("P. aeruginosa", "none"), ("12.4", "typographic"), ("4a", "ambiguous"), ("n", "markup"), ("5", "typographic"), ("7", "typographic")]
    assert [(n.label, n.label_source, n.text) for n in notes] == [("a", "markup", "mean"), ("*", "text", "significant")]


def test_sidecar_split_and_refusals():
    body = "<tr><td>1*</td><td>2**</td><td>x b</td></tr>"
    (_, notes), = sidecar.parse_tables(wrap(body, "<fn><p>* one ** two</p></fn>"))
    assert [(n.label, n.text) for n in notes if n.label] == [("*", "one"), ("**", "two")]
    (_, notes), = sidecar.parse_tables(wrap(body, "<fn><p>b) first</p></fn><fn><p>b second</p></fn>"))
    assert [n.label for n in notes] == [None, None]
    assert sidecar.opening_marker("Mean of three") is None and sidecar.opening_marker("a Mean") == "a"


def test_sidecar_metrics(spark):
    xml = wrap('<tr><th>H</th></tr><tr><td>3.5a</td></tr><tr><td>6</td></tr>', "<fn><label>a</label><p>x</p></fn><fn><label>b</label><p>y</p></fn>")
    docs = spark.createDataFrame([("s", xml), ("t", wrap("<tr><td>1</td></tr>", ""))], "source_id string, xml string")
    m = {r["source_id"]: r for r in sidecar.table_metrics(sidecar.table_cells(docs), sidecar.table_notes(docs)).collect()}
    assert m["s"]["footnote_resolution_rate"] == 0.5 and m["s"]["header_chain_coverage"] == 1.0 and m["s"]["typographic_share"] == 1.0
    assert m["t"]["footnote_resolution_rate"] is None and m["t"]["ambiguity_rate"] is None and m["t"]["header_chain_coverage"] == 0.0


def test_page_lines(spark):
    rows = []
    for p in range(1, 6):
        own = [f"J. Odd {p}", "Abstract" if p == 1 else f"text {chr(96 + p)} alpha", f"which {chr(106 + p)} is inter-", f"rupted here {chr(96 + p)}.", str(p + 40)]
        rows += [("d", p, k, t) for k, t in enumerate(own)]
    rows += [("d", 5, 10, "References"), ("d", 5, 11, "1. Someone"), ("d", 5, 12, "Appendix A"), ("d", 5, 13, "more")]
    lines = spark.createDataFrame(rows, "source_id string, page int, line_no int, text string")
    gone = pages.running_lines(lines)
    assert gone.where("kind = 'page_number'").count() == 5
    texts = [r["text"] for r in pages.clean_lines(lines).orderBy("page", "line_no").collect()]
    assert "J. Odd 1" not in texts and "1. Someone" not in texts and "References" not in texts and "more" in texts
    s = pages.assemble(pages.clean_lines(lines)).first()
    assert "interrupted here b." in s["full_text"] and s["sections"][0]["title"] == "Abstract" and len(s["pages"]) == 5
    assert pages.running_lines(lines.where("page < 3")).count() == 0


def test_layout_checks(spark):
    shape = "source_id string, page int, width double, line_no int, x0 double, y0 double, x1 double, y1 double"
    woven = [("d", 1, 100.0, k, 0.0 if k % 2 == 0 else 55.0, 10.0 * (k // 2), 45.0 if k % 2 == 0 else 100.0, 10.0 * (k // 2) + 8) for k in range(6)]
    boxes = spark.createDataFrame(woven, shape)
    assert pages.column_hops(boxes).first()["hops"] == 3 and pages.column_returns(boxes).first()["returns"] == 2
    over = spark.createDataFrame([("d", 1, 100.0, 0, 0.0, 0.0, 50.0, 10.0), ("d", 1, 100.0, 1, 1.0, 1.0, 50.0, 10.0), ("d", 1, 100.0, 2, 0.0, 50.0, 50.0, 60.0)], shape)
    assert pages.overprints(over).first()["overlapping"] == 2
    assert pages.collapse_repeats(["a", "b", "c"] * 2 + ["d"]) == ["a", "b", "c", "d"] and pages.collapse_repeats(["a", "a"]) == ["a", "a"]
    assert pages.is_successor("2.1", "2") and pages.is_successor("3", "2.4") and not pages.is_successor("5", "2") and pages.roman("XIV") == 14


def test_passes_and_hits(spark, tmp_path):
    own = tmp_path / "src1"
    own.mkdir()
    (own / "pass0.json").write_text(json.dumps([{"entity_type": "e", "record_id": "r", "fields": [{"verbatim_quote": "q", "field_name": "f", "value": "1" }]}]))
    (own / "pass1.json").write_text("not json")
    (own / "other.json").write_text("[]")
    records = artifacts.read_passes(spark, str(tmp_path))
    assert [(r["source_id"], r["pass_ix"], r["record_id"]) for r in records.collect()] == [("src1", 0, "r")]
    assert artifacts.pass_fields(records).first()["quote"] == "q"
    hit = json.dumps({"pmid": "1", "pubYear": "2020", "isOpenAccess": "Y", "title": "T", "pubTypeList": {"pubType": ["Retracted Publication"]}, "abstractText": " "})
    h = artifacts.describe_hits(spark.createDataFrame([(hit,)], "value string"))
    r = h.first()
    assert (r["year"], r["open_access"], r["retracted"], r["has_abstract"]) == (2020, True, True, False)
    assert artifacts.preview(h.withColumn("ord", F.lit(0))).first()["titles"] == ["T"]


def test_logs_and_lookups(spark, tmp_path):
    (tmp_path / "run.log").write_text("10:00:00 [p1] start\n10:01:00 [p1] done\n10:02:00 [p2] failed: usage limit\nnoise\n")
    log = artifacts.scan_log(spark, str(tmp_path / "run.log"))
    assert {r["paper"]: (r["last_s"] - r["first_s"], r["n_done"], r["n_failed"]) for r in log.collect()} == {"p1": (60, 1, 0), "p2": (0, 0, 1)}
    assert artifacts.post_mortem(log).first()["median_s"] == 60
    sig = spark.createDataFrame([("Read timed out",), ("bad JSON",), ("eh",)], "t string").select(artifacts.signature(F.col("t")).alias("s"))
    assert [r["s"] for r in sig.collect()] == ["timeout", "parse", "other"]
    names = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "name string")
    known = spark.createDataFrame([("a", "answered", 1), ("b", "answered", 2), ("b", "answered", 3), ("c", "unreachable", None)], "name string, state string, cid int")
    got = {r["name"]: (r["state"], r["resolved"]) for r in artifacts.resolve_names(names, known).collect()}
    assert [got[n][0] for n in "abcd"] == ["resolved", "ambiguous", "unreachable", "no_match"] and got["b"][1] is None and got["a"][1]["cid"] == 1
    rungs = spark.createDataFrame([("x", ["full name", "genus"])], "name string, candidates array<string>")
    hit = artifacts.resolve_rungs(rungs, spark.createDataFrame([("genus", 9)], "candidate string, taxon int")).first()
    assert (hit["rung"], hit["taxon"]) == (1, 9)


def test_output_tables(spark, tmp_path):
    t = OutputTables(spark, str(tmp_path / "db"))
    shape = "record_id string, source_id string, entity_type string, route string, source_status string, composite double, payload string, written_at string, seq long, allowed boolean"
    rows = [("r", "s", "e", None, "active", 1.0, "a", "t", 1, True), ("q", "s", "e", None, "active", 0.1, "b", "t", 2, False), ("z", "", "e", None, "active", 1.0, "c", "t", 3, True)]
    first = {r["record_id"]: r["outcome"] for r in t.upsert(spark.createDataFrame(rows, shape)).collect()}
    assert first["s:r"] == "written" and first["s:q"] == "denied" and sorted(first.values()) == ["denied", "denied", "written"]
    again = t.upsert(spark.createDataFrame([("r", "s", "e", None, "active", 1.0, "a", "t", 4, True), ("r", "s", "e", None, "active", 1.0, "x", "t", 5, True), ("s:r", "s", "e", None, "active", 1.0, "x", "t", 6, True)], shape))
    assert [r["outcome"] for r in again.orderBy("seq").collect()] == ["identical", "collision", "written"]  # a local id that begins like its source is another record
    assert {r["record_id"]: r["payload"] for r in t.records().collect()} == {"s:r": "a", "s:s:r": "x"}
    ruling = "record_id string, source_id string, verdict string, note string, adjudicator string, at string, seq long"
    refused = t.record_adjudications(spark.createDataFrame([("r", "s", "right", None, "k", "t", 1), ("r", "s", "wrong", None, "k", "t", 2), ("r", "s", "perhaps", None, "k", "t", 3)], ruling))
    assert refused.count() == 1 and t.adjudications().first()["verdict"] == "wrong"
    assert t.candidates().count() == 0


def test_streams(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").selectExpr("event_id", "ts", "event_type AS stage", "CAST(value AS LONG) AS tokens")
    events.unionByName(events.limit(50)).repartition(4).write.parquet(str(tmp_path / "in"))
    rows = ingest.read_stream(spark, str(tmp_path / "in"), "event_id long, ts timestamp, stage string, tokens long", 1)
    seen: list[int] = []
    ingest.run_available(ingest.first_seen(rows, ["event_id"], "ts", "3650 days"), str(tmp_path / "c1"), lambda b, _: seen.extend(r["event_id"] for r in b.collect()))
    assert sorted(seen) == sorted(r["event_id"] for r in events.collect())
    total: dict = {}
    ingest.run_available(ingest.windowed_usage(rows, delay="3650 days"), str(tmp_path / "c2"), lambda b, _: total.update({(r["window"], r["stage"]): r["calls"] for r in b.collect()}), mode="update")
    assert sum(total.values()) == 1050
    fuse = Fuse(max_calls=2, max_tokens=10**9)
    with pytest.raises(Exception, match="calls"):
        ingest.run_available(rows, str(tmp_path / "c3"), ingest.fused(lambda b, _: None, fuse))
    done = spark.createDataFrame([("a", "done"), ("b", "incomplete"), ("c", "empty")], "source_id string, state string")
    left = ingest.pending(spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "source_id string"), done)
    assert sorted(r["source_id"] for r in left.collect()) == ["b", "d"]


def test_fuse():
    fuse = Fuse(10, 100)
    fuse.record(60)
    with pytest.raises(FuseExceeded):
        fuse.record(60)
    with pytest.raises(ValueError):
        fuse.raise_ceiling("tokens", 50)
    fuse.raise_ceiling("tokens", 500)
    fuse.record(-5)
    assert fuse.snapshot()["tokens"] == 120


def draft() -> dict:
    fields = [{"name": "km", "type": "float", "unit": "mM", "valid_range": [0, 10]}, dict(name="kind", type="enum", enum=["a", "b"])]
    return {"fields": fields, "queries": [{"query": "enzyme"}], "gold_set": {"text": "gold", "n": 40, "calibrates": True, "independent_of_benchmark": True}}


def test_ratification(spark):
    items = sp.parse_proposal(draft())
    rulings = sp.default_rulings(items)
    assert all(i["status"] == "proposed" for i in items)
    for r in rulings.values():
        r["status"] = "accepted"
    spec = sp.build_spec(items, rulings, question="q", unit="one reading", task="regression")
    assert [f["name"] for f in spec.fields] == ["km", "kind"] and sp.the_query(spec) == "enzyme" and "calibrated" in spec.bar_provenance()
    changed = {**rulings, "field:km": {**rulings["field:km"], "payload": {**rulings["field:km"]["payload"], "unit": "M"}}}
    with pytest.raises(sp.SpecError, match="note"):
        sp.build_spec(items, changed)
    config = sp.plan(spec, run_id="a")
    assert config["config_hash"] == sp.plan(spec, run_id="b")["config_hash"] and sp.preflight(config, spec) == []
    assert len(sp.preflight({**config, "ensemble_k": 0, "review_lane": ["km"], "locked_fields": ["km"], "weights_key": "odd"})) == 3
    wide = spark.createDataFrame([("r", "1.5", "a"), ("s", "much", None)], "record_id string, km string, kind string")
    got = {r["record_id"]: (r["km"], r["mapping_invalid"]) for r in spec.typed_view(wide, ["record_id"]).collect()}
    assert got == {"r": (1.5, []), "s": (None, ["km"])} and spec.schema()["km"].dataType.simpleString() == "double"
    assert "km (float); in mM; within 0 to 10" in spec.context()


def test_refusals():
    base = {"fields": [{"name": "x", "type": "str"}], "ledger": [dict(item_id="field:x", status="accepted")]}
    sp.Spec.load(base)
    for bad, word in (
        ({"fields": [{"name": "y"}]}, "ratified"), ({"source_scope": {"adapters": ["literature"]}}, "query"), ({"gold_set": {"item_id": "g"}}, "gold"), ({"ml_task": "magic"}, "task"),
        ({"fields": [{"name": "x", "type": "str"}, {"name": "x_sd", "uncertainty_of": "x", "uncertainty_role": "spread"}]}, "uncertainty"),
    ):
        with pytest.raises(sp.SpecError, match=word):
            sp.Spec.load({**base, **bad})
    themes = sp.parse_themes({"themes": [{"name": "t", "claims": ["a", "zz"]}, {"name": "u", "claims": ["zz"]}]}, {"a"})
    assert themes == [{"theme": "t", "definition": "", "claims": ["a"]}]
    assert sp.freeze_themes({"fields": []}, themes, "v1")["version"] == "v2"
