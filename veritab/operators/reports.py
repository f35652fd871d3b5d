"""Reports over the tables: per source, per run, per theme, and the selection flow. Counts are DataFrames; only finished lines of text are made on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritab.operators.accounting import STREAMS


def source_counts(candidates: DataFrame, papers: DataFrame | None = None) -> DataFrame:
    """Records found and accepted for each source; with `papers`, sources without a record are there with nulls, which aren't zeros."""
    per = candidates.groupBy("source_id").agg(F.count("*").alias("n_found"), F.count_if(F.col("decision") == "allowed").alias("n_accepted"))
    return per if papers is None else papers.select("source_id").distinct().join(per, "source_id", "left")


def denial_totals(decided: DataFrame, top: int = 8) -> DataFrame:
    """The most frequent reason codes of denied records (`codes` array), with the number of records of each."""
    return decided.select("record_id", F.explode(F.array_distinct("codes")).alias("code")).groupBy("code").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "code").limit(top)


def run_totals(runs: DataFrame) -> DataFrame:
    """One row of a run's sources (source_id, state, n_records, n_written): done, failed and carried ones, and records."""
    return runs.agg(
        F.count("*").alias("n_sources"), *[F.count_if(F.col("state") == s).alias(f"n_{s}") for s in ("done", "empty", "incomplete", "error", "carried")], F.sum("n_records").alias("n_records"), F.sum("n_written").alias("n_written")
    )


def progress(papers: DataFrame, stores: DataFrame, runs: DataFrame) -> DataFrame:
    """(source_id, state) of a project's papers: no_store, to_do, or the state of the latest run (source_id, state, seq)."""
    last = runs.groupBy("source_id").agg(F.max_by("state", "seq").alias("_state"))
    held = stores.select("source_id").distinct().withColumn("_held", F.lit(True))
    out = papers.select("source_id").distinct().join(held, "source_id", "left").join(last, "source_id", "left")
    return out.select("source_id", F.when(F.col("_held").isNull(), "no_store").otherwise(F.coalesce("_state", F.lit("to_do"))).alias("state"))


def judge_scope(selected: DataFrame) -> DataFrame:
    """Records of each state of selection, and how many of them the judge sees."""
    return selected.groupBy("state").agg(F.count("*").alias("n"), F.count_if("to_judge").alias("n_judged"))


def leg_usage(usage: DataFrame) -> DataFrame:
    """Token streams of each leg of a resumed run. Legs are kept apart: their sum would count what was read again twice."""
    return usage.groupBy("leg").agg(*[F.sum(c).alias(c) for c in STREAMS])


def candidate(candidates: DataFrame, record_id: str, source_id: str) -> DataFrame:
    """One candidate by its key."""
    return candidates.where((F.col("record_id") == record_id) & (F.col("source_id") == source_id))


def record_view(candidates: DataFrame, stores: DataFrame, state: Column) -> DataFrame:
    """Candidates with the text of their source, and the evidence state that `state` reads from both; a missing store is a null text."""
    return candidates.join(stores.select("source_id", "text"), "source_id", "left").withColumn("evidence", state)


def flow_text(counts: dict[str, int | None]) -> str:
    """The selection flow in Markdown; a step that wasn't counted says so."""
    return "\n".join(["| step | n |", "|-|-|", *(f"| {k} | {'not counted' if v is None else format(v, ',')} |" for k, v in counts.items())])


def theme_sections(claims: DataFrame, themes: DataFrame, most: int = 400) -> DataFrame:
    """A Markdown section for each theme, and one for claims without: a line a claim, in order of source and record, `most` at most."""
    named = claims.join(themes.select(F.col("theme").alias("_t"), "definition"), F.col("theme") == F.col("_t"), "left").withColumn("_t", F.coalesce("_t", F.lit("unassigned")))
    lines = F.transform(F.slice(F.array_sort(F.collect_list(F.struct("source_id", "record_id", "claim"))), 1, most), lambda c: F.concat(F.lit("- "), c["claim"], F.lit(" ("), c["source_id"], F.lit(")")))
    grouped = named.groupBy(F.col("_t").alias("theme")).agg(F.max("definition").alias("definition"), F.count("*").alias("n_claims"), F.countDistinct("source_id").alias("n_sources"), lines.alias("lines"))
    head = F.concat(F.lit("## "), "theme", F.lit("\n"), F.coalesce(F.concat("definition", F.lit("\n")), F.lit("")), F.lit("\n"))
    return grouped.select("theme", "n_claims", "n_sources", F.concat(head, F.array_join("lines", "\n"), F.lit("\n")).alias("markdown"))
