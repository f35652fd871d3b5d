from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from veritab.functions import grounding as gr
from veritab.operators import gate, mapping, scoring
from veritab.operators.uncertainty import ROLES, companion, companion_fields, groups_of, uncertainty_reasons


@pytest.mark.parametrize(
    ("value", "quote", "mode"),
    [
        ("12.4", "a rate of 12.40 per second", "numeric_match"),
        ("12.4", "a rate of 13.1", "numeric_absent"),
        ("name 7", "isolated after 7 days", "string_absent"),
        ("corvol ether A", "the names corvol ethers A and B", "series_match"),
        ("corvol ether B", "the names corvol ethers A (1), B (2), and D1 (5)", "series_match"),
        ("mutant 3", "mutants 1-5 grew", "series_range_match"),
        ("mutant 9", "mutants 1-5 grew", "string_absent"),
        ("mutant c", "mutants d-a grew", "string_absent"),
        ("ab C", "abs C and D", "string_absent"),
        ("amylolyticus NOSO-4T", "S. amylolyticus, strain NOSO-4T", "interposed_match"),
        ("sp. Cra33g", "strain (Cra33g) of a sp. of X", "string_absent"),
        ("atra niger", "atratus was niger", "string_absent"),
        ("foo bar", "foo " + "x " * 60 + "bar", "string_absent"),
        ("x", " ", "no_quote"),
    ],
)
def test_ground_one(value, quote, mode):
    assert gr.ground([value], False, quote)[1] == mode


def test_ground_lists():
    assert gr.ground([], True, "q")[1] == "empty_list"
    score, mode, missing = gr.ground(["alpha", "beta", "gamma"], True, "alpha and beta")
    assert (mode, missing) == ("list_partial", ["gamma"]) and score == pytest.approx(2 / 3)


def test_repeat_and_agree(spark):
    rows = [([True, True],), ([True],), ([False, False, None],), ([True, False],), (None,)]
    got = [r["r"]["state"] for r in spark.createDataFrame(rows, "a array<boolean>").select(gr.repeat_and_agree(F.col("a")).alias("r")).collect()]
    assert got == ["supported", "not_run", "unsupported", "unstable", "not_run"]


def test_parse_verdicts():
    assert gr.parse_verdicts('{"verdicts": [{"record_id": "x", "verdict": "supported"}]}', ["a"]) == []
    assert gr.parse_verdicts('[{"verdict": "partial"}, {"verdict": "maybe"}]', ["a", "b"])[0]["record_id"] == "a"
    assert gr.parse_verdicts('[{"verdict": "partial"}]', ["a", "b"]) == []
    assert gr.parse_verdicts("a is clearly unsupported", ["a"])[0]["verdict"] == "unsupported"
    assert gr.parse_verdicts(None, ["a"]) == []


def test_composite_and_lattice(spark):
    c = scoring.composite({"c_grounded": F.col("g"), "c_ensemble": F.col("e")})
    rows = spark.createDataFrame([(1.0, 0.5), (1.0, None), (None, None)], "g double, e double").select(c.alias("c")).collect()
    assert [r["c"] for r in rows] == [pytest.approx(0.85), 1.0, None]
    assert scoring.achievable() == [0.0, 0.1, 0.2, 0.3, 0.7, 0.8, 0.9, 1.0]
    with pytest.raises(ValueError):
        scoring.composite({}, {"c_judge": 1.0})
    with pytest.raises(ValueError):
        scoring.required_agreement(1)


def scalar_gate(g: float, e: float, verdict: str | None) -> bool:
    """The gate for one record of one clean field, in plain Python."""
    return (0.35 * g + 0.15 * e) / 0.5 >= 0.95 and e >= 1 - 1e-9 and g >= 0.9 and verdict == "supported"


def test_gate_grid(spark):
    grid = [(g, e, v) for g in (0.0, 0.5, 0.9, 1.0) for e in (k / 3 for k in range(4)) for v in ("supported", "partial", "unsupported", "unparseable", None)]
    df = spark.createDataFrame(grid, "g double, e double, v string")
    comp = scoring.composite({"c_grounded": F.col("g"), "c_ensemble": F.col("e")})
    route = scoring.route(F.col("g"), F.col("e"), F.lit(False), 1.0)
    field = F.struct(
        F.lit("f").alias("field_name"), F.lit("1").alias("value"), F.lit("int").alias("value_kind"), route.alias("route"), F.lit(True).alias("has_provenance"), F.lit("active").alias("source_status"),
        F.lit("clean").alias("contradiction_search"), F.lit(0).alias("n_contradictions"), F.col("g").alias("c_grounded"),
    )
    why = gate.gate_reasons(comp, F.lit(None).cast("string"), F.array(field), F.col("v"))
    for r in df.withColumn("ok", gate.allowed(why)).collect():
        assert r["ok"] == scalar_gate(r["g"], r["e"], r["v"]), r


def test_gate_reasons_in_order(spark):
    bare = F.from_json(F.lit('{"field_name": "a", "route": "human_review", "has_provenance": false, "n_contradictions": 2}'), "field_name string, value string, value_kind string, route string, has_provenance boolean, source_status string, contradiction_search string, n_contradictions int, c_grounded double")
    status = bare.withField("field_name", F.lit("b")).withField("has_provenance", F.lit(True)).withField("source_status", F.lit("retracted")).withField("route", F.lit(None).cast("string"))
    policy = gate.Policy(locked=("z", "a"), min_populated=3)
    why = gate.gate_reasons(F.lit(0.5), F.lit("quarantine"), F.array(bare, status), F.lit("odd"), policy)
    got = [(r["code"], r["about"]) for r in spark.range(1).select(why.alias("w")).first()["w"]]
    assert got == [("composite_below_bar", "0.500000"), ("record_route", "quarantine"), ("locked_field_absent", "z"), ("too_few_populated", "0"), ("field_route", "a"), ("no_provenance", "a"), ("source_status", "b:retracted"), ("contradicted", "b"), ("judge", "not_run")]
    lane = gate.selection_reasons(F.lit(1.0), F.lit(None).cast("string"), F.array(bare), gate.Policy(lane=("a",)))
    assert spark.range(1).select(lane.alias("w")).first()["w"] == []
    none = gate.selection_reasons(F.lit(None).cast("double"), F.lit(None).cast("string"), F.lit(None).cast(f"array<{gate.FIELD}>"))
    assert [r["code"] for r in spark.range(1).select(none.alias("w")).first()["w"]] == ["composite_missing", "no_fields"]


def test_thresholds(monkeypatch):
    monkeypatch.setenv("VERITAB_ACCEPT_BAR", "0.8")
    assert gate.resolve_threshold() == 0.8 and gate.resolve_threshold(0.0) == 0.0 and gate.resolve_threshold(-1) == 0.8
    monkeypatch.setenv("VERITAB_ACCEPT_BAR", "high")
    assert gate.resolve_threshold() == 0.95
    assert gate.single_pass_problems(1, True, 0, False) == ["ensemble_signal_present", "no_completeness_minimum", "grounding_not_checked"]
    assert gate.single_pass_problems(3, True, 0, False) == []


def test_uncertainty_roles():
    fields = [{"name": "x", "type": "float"}, *companion_fields("x", "mM")]
    groups = groups_of(fields)
    assert groups == {"x": {r: companion("x", r) for r in ROLES}}


def test_uncertainty_partial_group(spark):
    why = uncertainty_reasons({"x": F.lit("1")}, {"x": {"spread_type": "x_t"}})
    assert [r["code"] for r in spark.range(1).select(why.alias("w")).first()["w"]] == ["uncertainty_group_partial"]


def test_mapping(spark):
    def run(v, *a, **k):
        return spark.range(1).select(mapping.validate(F.lit(v).cast("string"), *a, **k).alias("r")).first()["r"]

    assert run("12 mM", "float", (0, 10))["flags"] == ["out_of_range"]
    assert run("none", "float")["flags"] == ["not_numeric"]
    assert run("b", "enum", enum=["a"])["ok"] is False and run("a", "enum", enum=["a"])["c_grounded"] == 1.0
    shape = mapping.shape_issues(F.array(F.lit("a and b; c")), F.lit(False), "list[str]")
    assert spark.range(1).select(shape.alias("s")).first()["s"] == ["single_value", "prose"]
    bad = mapping.provenance_violations({"process_fingerprint": F.lit("xyz"), "ontology_id": F.lit("o"), "source_chars_total": F.lit(5), "source_chars_read": F.lit(9), "char_offset": F.lit(9)})
    assert spark.range(1).select(bad.alias("b")).first()["b"] == ["fingerprint_not_sha256", "ontology_half_given", "read_beyond_total", "offset_beyond_read"]
    frac = mapping.retained_fraction(F.lit(3), F.lit(0))
    assert spark.range(1).select(frac.alias("f")).first()["f"] == 0.0
