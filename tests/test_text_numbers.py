from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from veritab.functions import numbers as nu
from veritab.functions import text as tx
from veritab.operators import agreement as ag


def one(spark, expr, **values):
    """Value of an expression over one row of string columns."""
    cols = [F.lit(v).cast("string").alias(k) if not isinstance(v, (list, bool, int, float)) else F.lit(v).alias(k) for k, v in values.items()] or [F.lit(1).alias("x")]
    return spark.range(1).select(*cols).select(expr.alias("r")).first()["r"]


@pytest.mark.parametrize(
    ("text", "number"),
    [("4.20", 4.2), ("1e-3 M", 0.001), ("6.5uM", 6.5), ("2-MIB", None), ("31.5 h-1", 31.5), ("4.2-4.8", None), ("NRRL 12345", None), ("1,234", 1234.0), ("−3", -3.0), (None, None), ("", None)],
)
def test_as_number(spark, text, number):
    assert one(spark, nu.as_number(F.col("t")), t=text) == number


@pytest.mark.parametrize(("text", "number"), [("1.5", 1.5), ("nan", None), ("1f", None), ("1_0", None), (" 7 ", 7.0), ("7 kg", None), ("inf", None)])
def test_strict_number(spark, text, number):
    assert one(spark, nu.strict_number(F.col("t")), t=text) == number


def test_counts_and_sentinel(spark):
    assert tuple(one(spark, nu.count_or_range(F.col("t")), t="3-5")) == (3, 5)
    assert one(spark, nu.count_or_range(F.col("t")), t="5-3") is None
    assert tuple(one(spark, nu.count_or_range(F.col("t")), t="12")) == (12, 12)
    assert one(spark, nu.is_not_reported(F.col("t")), t=" Not Reported ") is True
    assert one(spark, nu.is_not_reported(F.col("t")), t=None) is False


@pytest.mark.parametrize(
    ("a", "b", "agree"),
    [("4.2", "4.20", True), ("4.2", "4.21", True), ("4.2", "4.5", False), ("5 µM", "5 μM", True), ("E. coli", "e.  COLI", True), ("2-MIB", "2-methylisoborneol", False), ("x²", "x2", True), (None, None, True), (None, "x", False), ("a-b", "a–b", True)],
)
def test_values_agree(spark, a, b, agree):
    assert one(spark, ag.same(ag.comparable(F.col("a")), ag.comparable(F.col("b"))), a=a, b=b) is agree


def test_agreement_groups_by_first_member_in_order(spark):
    def run(values):
        arr = F.array(*[ag.comparable(F.lit(v).cast("string"), ("spaces", "lower")) for v in values])
        return spark.range(1).select(ag.agreement(arr).alias("a")).select("a.*").first().asDict()

    r = run(["1.000", "1.009", "1.018"])  # the third is near the second, not the first
    assert r["n_agreeing"] == 2 and r["modal"] == "1.000" and not r["ambiguous"]
    tie = run([None, "b", "a"])
    assert tie["ambiguous"] and tie["modal"] is None and 3 * tie["c_ensemble"] == pytest.approx(1) and tie["n_missing"] == 1
    assert run([None, None])["c_ensemble"] is None
    assert [g["value"] for g in run(["b", "a", "A"])["groups"]] == ["a", "b"]


def test_binomials(spark):
    got = one(spark, ag.expand_binomials(F.array(F.lit("S. coelicolor"), F.lit("Streptomyces coelicolor"), F.lit("S. albus"))))
    assert got == ["Streptomyces coelicolor", "Streptomyces coelicolor", "S. albus"]


def test_consistency(spark):
    def run(*values):
        return one(spark, ag.consistency(F.array(*[F.lit(v).cast("double") for v in values])))

    assert run(1.0, 1.0, 1.0) == 1.0
    assert run(1.0, None, 1.0) is None
    assert run(0.0, 0.0) == 1.0 and run(-1.0, 1.0) == 0.0
    assert run(12.4, 12.4, 1240.0) == 0.0


def test_text_rules(spark):
    assert one(spark, tx.normalize_doi(F.col("t")), t=" https://doi.org/10.1/AB ") == "10.1/ab"
    assert one(spark, tx.title_key(F.col("t")), t="<i>On</i> Mice &amp; Men!") == "on mice men"
    assert one(spark, tx.is_correction_title(F.col("t")), t="Erratum to: X") is True
    assert one(spark, tx.strip_correction(F.col("t")), t="Correction: A thing") == "A thing"
    assert one(spark, tx.next_version(F.col("t")), t="v9") == "v10"
    assert one(spark, tx.slug(F.col("t")), t=" 3 Big Cats! ") == "p_3_big_cats"
    assert one(spark, tx.dirname(F.col("t")), t="PMC:1/2") == "PMC_1_2"
    assert one(spark, tx.smiles_kind(F.col("t")), t="C[C@H](O)N") == "isomeric"
    assert [tuple(b) for b in one(spark, tx.sentence_bounds(F.col("t")), t="Ab. Cd!  Ef")] == [(0, 3), (4, 7), (9, 11)]
    assert one(spark, tx.surface_of(tx.tag_surface(F.col("t"), "chat")), t="kim") == "chat"
    assert one(spark, tx.quote_at(F.col("t"), F.lit(1), F.lit(3)), t="µδ😀x") == "δ😀"
    assert one(spark, tx.log_seconds(F.col("t")), t="01:02:03") == 3723
    assert one(spark, tx.fold_strain(F.col("t")), t="Streptomyces sp. strain NRRL 123")["folded"] == "Streptomyces"
    assert one(spark, tx.taxon_candidates(F.col("t")), t="Escherichia coli ATCC 25922")[-1] == "Escherichia"
    assert one(spark, tx.species_epithet(F.col("t")), t="Escherichia coli K-12") == "coli"
    with pytest.raises(ValueError):
        tx.normalize(F.col("t"), ("nonsense",))
