"""What keeps queries from growing faster than their tables: moves, pairs and steps that are bounded, with the same results."""

from __future__ import annotations

import difflib
import random
import time

import pandas as pd
from pyspark.sql import functions as F

from veritab.functions.text import _places, _reaches, normalize, title_key
from veritab.operators import assembly, corpus, gate, merge, selection
from veritab.plans import registry, replay
from veritab.sources import pages


def test_passes_move_once(spark):
    """Records and fields are laid out by source a single time and nothing is written out on the way (F1, F2); results are those of the separate steps."""
    records = spark.createDataFrame(
        [("s", 0, 0, "r1", "item"), ("s", 0, 1, "r1", "item"), ("s", 0, 2, "r9", "item"), ("s", 1, 0, "r2", "item"), ("s", 1, 1, "r1", "thing"), ("t", 2, 0, "r1", "item")],
        "source_id string, pass_ix int, rec_ix int, record_id string, entity_type string",
    ).withColumns({"review_only": F.lit(False), "review_reason": F.lit(None).cast("string")})
    rows = [("s", 0, 0, "A", "1", "q0"), ("s", 0, 1, "B", "2", "q1"), ("s", 0, 2, "a ", "3", "q2"), ("s", 1, 0, "A", "1", "q3"), ("s", 1, 1, "A", None, "q4"), ("t", 2, 0, "Å", "5", "q5"), (None, 0, 0, "A", "7", "q6"), ("u", 0, 0, "A", "8", "q7")]
    fields = spark.createDataFrame([(s, p, r, k, n, v, q + n) for s, p, r, c, x, q in rows for k, n, v in ((0, "code", c), (1, "x", x))], "source_id string, pass_ix int, rec_ix int, ord int, field_name string, value string, quote string")
    aligned, merged = replay.merged_records(records, fields, merge.Identity.of("code"), 3)
    assert merged._jdf.queryExecution().optimizedPlan().toString().count("RepartitionByExpression") == 1
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    key = ["source_id", "pass_ix", "rec_ix"]
    n = fields.where("field_name = 'code'").select(*key, normalize(F.col("value")).alias("_id"))
    known = merge.with_identity(records.join(n, key, "left"), merge.Identity.of("code"), {"code": F.col("_id")}).where("not identity_error")
    ids = merge.align(known)
    keys = ["source_id", "entity_type", "identity"]
    tagged = fields.join(known.select(*key, "entity_type", "identity"), key)
    want = merge.quote_donor(merge.merge_fields(known, fields, 3), tagged, keys).join(ids.select(*keys, F.col("merged_id").alias("record_id")), keys)
    cols = [*keys, "record_id", "field_name", "value", "quote", "from_pass", "n_agreeing", "n_missing", "ambiguous", "c_ensemble"]
    got = sorted(map(str, merged.select(cols).collect()))
    assert got == sorted(map(str, want.select(cols).collect())) and len(got) == 7
    assert sorted(map(str, aligned.select(ids.columns).collect())) == sorted(map(str, ids.collect()))


def test_titles_are_ruled_out_by_subsequences(spark, monkeypatch):
    """Titles of the same letters never reach the matcher, a common length is many cells, and the pairs are all that brute force finds (F3)."""
    rng = random.Random(5)
    base = ["".join(rng.choice("abcde fgh") for _ in range(rng.choice((40, 60, 230)))).strip() for _ in range(30)]
    titles = base + ["".join(c for c in t if rng.random() > 0.04) for t in base] + ["".join(rng.sample(t, len(t))) for t in base] + ["", "a"]
    monkeypatch.setattr(corpus, "CELL", 16)
    papers = spark.createDataFrame([(k, t, ["Ann Name"], 2000 + k % 3) for k, t in enumerate(titles)], "ord long, title string, authors array<string>, year int")
    got = {(r["ord"], r["other_ord"]): r["ratio"] for r in corpus.title_pairs(papers).collect()}
    keys = [r["k"] for r in papers.orderBy("ord").select(title_key(F.col("title")).alias("k")).collect()]
    want, least = {}, corpus.FUZZY - 2 * corpus.NUDGE
    for x in range(len(keys)):
        for y in range(x):
            r = difflib.SequenceMatcher(None, keys[x], keys[y]).ratio() if keys[x] and keys[y] else 0.0
            if r >= least:
                want[x, y] = min(1.0, min(1.0, r + corpus.NUDGE) + corpus.NUDGE * (x % 3 == y % 3))
    assert len(want) >= 15 and {k: round(v, 9) for k, v in got.items() if v >= least} == {k: round(v, 9) for k, v in want.items()}
    shuffled = [(keys[k], keys[k + 60]) for k in range(30)]
    assert not any(_reaches(a, b, least, _places(a)) for a, b in shuffled)


def test_replay_moves_only_lines(spark):
    """Passes, fields and sources lie where the lines do, and joins on source and record move neither side (F2)."""
    plan = registry.queries()["replay_records"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    moves = [line.split("Exchange ")[1] for line in plan.splitlines() if "Exchange " in line and "Broadcast" not in line]
    assert moves and all(m.startswith("hashpartitioning(source_id#") and "REPARTITION_BY_NUM" in m for m in moves)


def test_laid_out_merge_and_joins(spark):
    """Values beyond ASCII meet the others where these lie, and a join in place is the join (F2)."""
    said = [("s", 0, "a", "µM 5"), ("s", 1, "a", "uM 5"), ("s", 2, "a", None), ("t", 0, "ﬁx", "1"), ("t", 1, "fix", "1"), ("u", 0, "", "x")]
    fields = spark.createDataFrame([(s, p, 0, k, n, v, f"q {v}") for s, p, c, x in said for k, n, v in ((0, "code", c), (1, "x", x))], "source_id string, pass_ix int, rec_ix int, ord int, field_name string, value string, quote string")
    records = fields.where("ord = 0").select("source_id", "pass_ix", "rec_ix", F.lit("r").alias("record_id"), F.lit("item").alias("entity_type"), F.lit(False).alias("review_only"), F.lit(None).cast("string").alias("review_reason"))
    want = replay.merged_records(records, fields, merge.Identity.of("code"), 3)
    got = replay.merged_records(records.repartition(3, "source_id"), fields.repartition(3, "source_id"), merge.Identity.of("code"), 3, 3)
    for a, b in zip(got, want):
        assert sorted(map(str, a.collect())) == sorted(map(str, b.select(a.columns).collect()))
    assert {(r["source_id"], r["field_name"], r["n_agreeing"]) for r in got[1].collect()} >= {("s", "x", 2), ("t", "code", 2)}
    rows = spark.createDataFrame([("s", "r", 1), ("s", "r", 2), ("s", None, 3), (None, "r", 4), ("t", "r", 5)], "source_id string, record_id string, n int")
    found = spark.createDataFrame([("s", "r", "a"), ("s", "r", None), ("s", None, "b"), (None, "r", "c"), ("v", "r", "d")], "source_id string, record_id string, verdict string")
    key = ["source_id", "record_id"]
    near = assembly.with_found(rows.repartition(3, "source_id"), found.repartition(3, "source_id"), key, 3)
    assert sorted(map(str, near.select("n", "verdict").collect())) == sorted(map(str, rows.join(found, key, "left").select("n", "verdict").collect()))


def _facts_case(spark):
    """Random fields of records, some of which have none, with every state that the gate asks about."""
    rng = random.Random(3)
    names, routes = ["f1", "f2", "f7", "note"], ["auto_accept", "human_review", "quarantine", None]
    fields = [(r, rng.choice(names), rng.choice(["1", "", None, "not reported"]), "string", rng.choice(routes), rng.choice([True, True, False, None]), rng.choice(["clean", "clean", "not_run", None]), rng.choice([0, 0, 2, None]), rng.choice([0.0, 0.5, 1.0, None]), rng.choice([0.2, 0.95, 1.0, None])) for r in range(300) for _ in range(rng.randrange(5))]
    records = [(r, rng.choice(["active", "active", "retracted", None]), rng.choice([None, None, "human_review", "auto_accept"]), rng.choice([None, "supported", " Supported", "partial"])) for r in range(300)]
    f = spark.createDataFrame(fields, "rec int, field_name string, value string, value_kind string, route string, has_provenance boolean, contradiction_search string, n_contradictions int, c_grounded double, confidence double")
    return f, spark.createDataFrame(records, "record_id int, status string, own string, verdict string")


def test_gate_in_numbers_is_the_gate(spark):
    """Counts of fields give the reasons, classes and root causes that arrays of fields give (F4, F6)."""
    f, records = _facts_case(spark)
    for policy in (gate.Policy(lane=("f7",), locked=("f1", "f2"), min_populated=2, companions=("note",)), gate.Policy(bar=0.9), gate.Policy(require_search=False, min_populated=1)):
        outside = ~F.col("field_name").isin(list(policy.lane)) if policy.lane else F.lit(True)
        one = F.struct("field_name", "value", "value_kind", "route", "has_provenance", F.lit(None).cast("string").alias("source_status"), "contradiction_search", "n_contradictions", "c_grounded")
        wide = records.join(f.groupBy("rec").agg(F.min(F.when(outside, F.col("confidence"))).alias("composite"), F.collect_list(one).alias("fields")), F.col("rec") == F.col("record_id"), "left")
        wide = wide.withColumn("fields", F.coalesce(F.transform("fields", lambda x: x.withField("source_status", F.col("status"))), F.expr(f"cast(array() as array<{gate.FIELD}>)")))
        why = gate.gate_reasons(F.col("composite"), F.col("own"), F.col("fields"), F.col("verdict"), policy)
        want = wide.select("record_id", F.array_sort(gate.reason_codes(why)).alias("codes"), gate.denial_class(F.col("own"), F.col("fields")).alias("class"), (gate.diagnose(why, F.col("fields"))["root"]["code"] == "ungrounded").alias("ungrounded"))
        facts = records.join(gate.field_facts(f, "rec", policy), F.col("rec") == F.col("record_id"), "left")
        counts = gate.reason_counts(F.col("weakest"), F.col("own"), F.col("status"), F.col("verdict"), policy)
        codes = F.array_sort(F.flatten(F.array(*[F.array_repeat(F.lit(c), n.cast("int")) for c, n in counts.items()])))
        follows = sum((n for c, n in counts.items() if c in gate.FOLLOWS), F.lit(0)) > 0
        got = facts.select("record_id", codes.alias("codes"), gate.class_of_facts(F.col("own"), F.col("status")).alias("class"), (follows & F.coalesce(F.col("n_ungrounded") > 0, F.lit(False))).alias("ungrounded"))
        assert {r["record_id"]: (r["codes"], r["class"], bool(r["ungrounded"])) for r in got.collect()} == {r["record_id"]: (r["codes"], r["class"], bool(r["ungrounded"])) for r in want.collect()}


def test_audit_without_a_sort_is_the_slice(spark):
    """The slice found from counts of keys is the one found by ranks, and its query ranks nothing (F4)."""
    ids = spark.range(3000).withColumnRenamed("id", "record_id")
    among = F.col("record_id") % 3 > 0
    for share in (0.0, 0.0003, 0.1, 1.0):
        got = selection.audited(ids, among, share, "salt").where("_audit").select("record_id")
        want = selection.audit_slice(ids.where(among), share, "salt")
        assert sorted(r[0] for r in got.collect()) == sorted(r["record_id"] for r in want.collect())
    assert selection.audited(ids.where("false"), among, 0.1, "salt").count() == 0


def test_gate_queries_hold_no_arrays_of_fields(spark):
    """No query of the gate collects the fields of a record (F4, F6)."""
    for name in ("select_for_judging", "denial_root_causes", "gate_decision", "gate_reason_hist", "denial_class_hist", "denial_totals"):
        plan = registry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert "collect_list" not in plan


def test_fields_move_narrow_and_are_counted_once(spark, monkeypatch):
    """Fields move as a few numbers and are put together a single time, by record; names as bits give what groups by name give (F6)."""
    plan = registry.queries()["denial_root_causes"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [rec#") == 1 and plan.count("RepartitionByExpression [rec#") == 1
    moved = registry.queries()["gate_decision"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_COL" in moved and "told#" in moved and "_marks_0#" in moved
    f, _ = _facts_case(spark)
    odd = f.limit(40).withColumns({"rec": F.col("rec") % 7, "field_name": F.when(F.col("rec") % 2 == 0, F.lit(None)).otherwise(F.lit("Å"))})
    many = f.unionByName(odd).unionByName(f.where("rec < 40").withColumn("field_name", F.concat("field_name", F.lit("_"), F.col("rec") % 15)))
    locked = tuple(f"f1_{k}" for k in range(25))
    for fields, policy in ((many, gate.Policy(lane=("f7",), locked=("f1", "f2"), min_populated=2, companions=("note",))), (many, gate.Policy(locked=locked, min_populated=3)), (many.where("field_name is null"), gate.Policy(min_populated=1)), (f.where("false"), gate.Policy(min_populated=1))):
        got = {}
        for most in (gate.NAMES, 0):
            monkeypatch.setattr(gate, "NAMES", most)
            facts = gate.field_facts(fields, "rec", policy)
            got[most] = sorted(map(str, facts.select(sorted(facts.columns)).collect()))
            monkeypatch.undo()
        assert got[gate.NAMES] == got[0] and (got[0] or policy.min_populated == 1)


def test_names_beyond_the_bits(spark):
    """63 names and none are bits, one more is grouped by name, and each is counted (F6)."""
    for n in (63, 64):
        fields = spark.range(2 * n + 2).select(
            (F.col("id") % 2).alias("rec"), F.when(F.col("id") < 2 * n, F.concat(F.lit("n"), F.floor(F.col("id") / 2).cast("string"))).alias("field_name"), F.lit("1").alias("value"), F.lit("int").alias("value_kind"), F.lit(None).cast("string").alias("route"),
            F.lit(True).alias("has_provenance"), F.lit("clean").alias("contradiction_search"), F.lit(0).alias("n_contradictions"), F.lit(1.0).alias("c_grounded"), F.lit(1.0).alias("confidence"),
        )
        assert (gate.few_names(fields) is None) == (n > 63)
        got = gate.field_facts(fields, "rec", gate.Policy(min_populated=1)).collect()
        assert [(r["n_populated"], r["n_fields"]) for r in got] == [(n + 1, n + 1)] * 2


def test_long_paragraphs_are_joined_in_pieces(monkeypatch):
    """A document that is one paragraph costs in proportion to its lines, and pieces join as whole texts do (F7)."""
    said = ["1 One", "of the respon-", "dents -", "-", "x", "", "A-", "B", "1.1 Two", "y", "2 Three", "Methods", "z-"]
    lines = pd.DataFrame([("s", k // 4 + 1, k, t) for k, t in enumerate(said)] + [("s", None, 0, "lost")], columns=["source_id", "page", "line_no", "text"])
    got = pages._assemble(lines.sample(frac=1, random_state=1)).iloc[0]
    assert got["full_text"] == "1 One\n\nof the respondents - x\n\nA- B\n\n1.1 Two\n\ny\n\n2 Three\n\nMethods\n\nz-\n\n"
    text = got["full_text"]
    assert [(s["title"], text[s["start"] :].startswith(s["title"]), s["end"], s["depth"]) for s in got["sections"]] == [("1 One", True, text.index("2 Three"), 0), ("1.1 Two", True, text.index("2 Three"), 1), ("2 Three", True, text.index("Methods"), 0), ("Methods", True, len(text), 0)]
    assert [p["page_no"] for p in got["pages"]] == [1, 2, 3, 4] and got["pages"][1]["start"] == got["pages"][0]["end"]

    def took(n: int) -> float:
        long = pd.DataFrame({"source_id": "s", "page": [k // 4 + 1 for k in range(n)], "line_no": range(n), "text": f"a line of {'many words ' * 20}"})
        began = time.process_time()
        pages._assemble(long)
        return time.process_time() - began

    took(1000)
    assert took(80_000) < 12 * max(took(20_000), 0.05)
