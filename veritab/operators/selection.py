"""From scored records to what the judge sees: selection, audit sample, verdicts, and open questions."""

from __future__ import annotations

import hashlib
import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veritab.functions.once import once
from veritab.operators.gate import Policy, denial_class, selection_reasons
from veritab.operators.order import ranked_within


@F.pandas_udf(T.StringType())
def blake_key(text: pd.Series) -> pd.Series:
    """BLAKE2b-128 of a text in hexadecimal."""
    return text.map(lambda s: None if s is None else hashlib.blake2b(s.encode(), digest_size=16).hexdigest())


def audit_slice(ids: DataFrame, fraction: float, salt: str, by: list[str] | None = None, ident: str = "record_id", key=None) -> DataFrame:
    """ceil(fraction x n) ids with the least hash of "salt|id", for each group: the same ones in whatever order they come.

    `key` maps the salted id to its sort key; BLAKE2b by default.
    """
    by = by or []
    salted = F.concat(F.lit(f"{salt}|"), F.col(ident).cast("string"))
    keyed = ids.withColumn("_key", (key or blake_key)(salted))
    ranked = ranked_within(keyed, by, [F.col("_key"), F.col(ident)])
    return ranked.where(F.col("_n") <= F.ceil(F.lit(fraction) * F.col("_of"))).drop("_key", "_n", "_of")


def audited(ids: DataFrame, among: Column, fraction: float, salt: str, ident: str = "record_id", key=None) -> DataFrame:
    """`ids`, each once, with _audit: whether `audit_slice` of those that are `among` has them.

    The last id of the slice is found from counts of the first digits of the
    keys (hexadecimal) and from the ids with its digits; nothing is sorted. `ids` is read three times.
    """
    made = (key or blake_key)(F.concat(F.lit(f"{salt}|"), F.col(ident).cast("string")))
    keyed = ids.withColumn("_key", F.when(among, made)).withColumn("_bin", F.substring("_key", 1, 4))
    bins = sorted((r["_bin"], r["n"]) for r in keyed.where("_key is not null").groupBy("_bin").agg(F.count("*").alias("n")).collect())
    rest = math.ceil(fraction * sum(n for _, n in bins))
    last = F.lit(False)
    for digits, n in bins:
        if 0 < rest <= n:
            end = keyed.where(F.col("_bin") == digits).select("_key", ident).orderBy("_key", ident).limit(rest).agg(F.max(F.struct("_key", ident)).alias("m")).first()["m"]
            last = (F.col("_bin") < digits) | (F.col("_key") < end[0]) & (F.col("_bin") == digits) | (F.col("_key") == end[0]) & (F.col(ident) <= F.lit(end[1]))
            break
        rest -= n
    return keyed.withColumn("_audit", F.coalesce(last, F.lit(False))).drop("_key", "_bin")


def keep_first(records: DataFrame, keys: list[str], seq: str) -> tuple[DataFrame, DataFrame]:
    """The first record of each key, and the ids that came again."""
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(seq))
    ranked = records.withColumn("_n", n)
    return ranked.where("_n = 1").drop("_n"), ranked.where("_n > 1").select(*keys).distinct()


def select_for_judging(scored: DataFrame, policy: Policy, fraction: float, salt: str, seq: str = "seq", strict: Column | None = None) -> DataFrame:
    """First of each record id with state selected, audit or rejected, denial_class of those turned down, and to_judge.

    Selected records pass all conditions but the judge's and completeness
    (`strict`, when given, adds further reasons). Of those turned down for thin
    or contradicted evidence, a hashed share is judged all the same.
    """
    first, _ = keep_first(scored, ["record_id"], seq)
    loose = Policy(bar=policy.bar, lane=policy.lane, require_search=True)
    why = selection_reasons(F.col("composite"), F.col("route"), F.col("fields"), loose)
    if strict is not None:
        why = F.concat(why, strict)
    told = once(why, lambda w: F.struct(w.alias("selection"), F.when(F.size(w) > 0, denial_class(F.col("route"), F.col("fields"))).alias("denial_class")))
    judged = first.withColumn("_t", told).select(*first.columns, "_t.selection", "_t.denial_class")
    audit = audit_slice(judged.where(F.col("denial_class").isin("thin_evidence", "contradicted")).select("record_id"), fraction, salt).withColumn("_audit", F.lit(True))
    out = judged.join(audit, "record_id", "left")
    state = F.when(F.size("selection") == 0, "selected").when(F.col("_audit"), "audit").otherwise("rejected")
    return out.withColumn("state", state).withColumn("to_judge", F.col("state") != "rejected").drop("_audit")


def apply_verdicts(selected: DataFrame, verdicts: DataFrame) -> DataFrame:
    """judge_verdict and judge_note (at most 400 characters): answered, asked without an answer (unparseable), or not asked (not_run)."""
    v = verdicts.select("record_id", F.col("verdict").alias("_v"), F.col("note").alias("_note"))
    out = selected.join(v, "record_id", "left")
    return out.withColumn("judge_verdict", F.when(F.col("_v").isNotNull(), F.col("_v")).when(F.col("to_judge"), "unparseable").otherwise("not_run")).withColumn("judge_note", F.substring("_note", 1, 400)).drop("_v", "_note")


def question_catalogue(fields: DataFrame, records: DataFrame, alignment: DataFrame | None = None) -> DataFrame:
    """(source_id, kind, detail): what a person may have to settle, one row a question, repeats removed.

    fields: source_id, record_id, field_name, ambiguous, c_ensemble, c_grounded, n_contradictions, contradiction_search, is_inferential.
    records: source_id, record_id, review_only, n_fields, found_by_passes, k. alignment: source_id, entity_type, identity_tier.
    """
    at = F.concat_ws("/", "record_id", "field_name")

    def ask(df: DataFrame, cond: Column, kind: str, detail: Column) -> DataFrame:
        return df.where(cond).select("source_id", F.lit(kind).alias("kind"), detail.cast("string").alias("detail"))

    rows = [
        ask(fields, F.col("ambiguous"), "ambiguous_value", at),
        ask(fields, F.col("c_ensemble") < 1, "passes_disagree", at),
        ask(fields, F.col("c_grounded") <= 0, "value_not_in_quote", at),
        ask(fields, (F.col("c_grounded") > 0) & (F.col("c_grounded") < 1), "value_partly_in_quote", at),
        ask(fields, F.col("n_contradictions") > 0, "contradicted", at),
        ask(fields, F.col("contradiction_search") == "not_run", "not_searched", at),
        ask(fields, F.col("is_inferential"), "inferred", at),
        ask(records, F.col("review_only"), "extractor_asked", F.col("record_id")),
        ask(records, F.col("n_fields") == 0, "empty_extraction", F.col("record_id")),
        ask(records, F.col("found_by_passes") < F.col("k"), "missed_by_a_pass", F.col("record_id")),
    ]
    if alignment is not None:
        rows.append(ask(alignment, F.col("identity_tier").startswith("ordinal"), "weak_identity", F.concat_ws("/", "entity_type", "identity_tier")))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out.distinct()


def run_questions(alignment: DataFrame, values: DataFrame, judged: DataFrame, blocked: DataFrame, failures: DataFrame, dropped: DataFrame, runs: DataFrame, lane: tuple[str, ...] = ()) -> DataFrame:
    """(source_id, kind, about): what a run leaves to a person, one row a question.

    alignment: source_id, identity, found_by_passes, identity_tier, anchor_unique. One found by a single pass asks about scope; else one matched
    by order alone is weak, and one anchored on a quote that occurs again is ambiguous.
    values: source_id, record_id, field_name, ambiguous; fields of the lane always differ and ask nothing.
    judged: source_id, record_id, kind (no_verdict, judge_veto, audit_disagreement, colliding_record_id). blocked: source_id, n records that no
    search for counter-evidence was completed for; one question a source. failures: source_id, pass, why. dropped: source_id, record_id, why;
    a value without any quote asks nothing. runs: source_id, state; error and incomplete ones ask.
    """
    def ask(df: DataFrame, kind: Column, about: Column) -> DataFrame:
        return df.select("source_id", kind.alias("kind"), about.cast("string").alias("about")).where("kind is not null")

    tier = F.col("identity_tier")
    scope = F.when(F.col("found_by_passes") == 1, "scope_disagreement").when(tier == "ordinal", "weak_identity").when((tier == "anchored") & ~F.coalesce("anchor_unique", F.lit(True)), "ambiguous_anchor")
    state = F.when(F.col("state") == "error", "paper_failed").when(F.col("state") == "incomplete", "verification_skipped")
    parts = [
        ask(alignment, scope, F.col("identity")),
        ask(values.where(F.col("ambiguous") & ~F.col("field_name").isin(list(lane))), F.lit("no_consensus_value"), F.concat_ws("/", "record_id", "field_name")),
        ask(judged, F.when(F.col("kind").isin("no_verdict", "judge_veto", "audit_disagreement", "colliding_record_id"), F.col("kind")), F.col("record_id")),
        ask(blocked.where("n > 0"), F.lit("verification_unusable"), F.col("n")),
        ask(failures, F.lit("pass_failed"), F.concat_ws(": ", "pass", "why")),
        ask(dropped.where("why <> 'no quote'"), F.lit("unanchorable_quote"), F.col("record_id")),
        ask(runs, state, F.col("state")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
