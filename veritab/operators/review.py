"""Review: output tables keyed by record and source, queues, rulings, views of one record, and exports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritab.functions.text import surface_of
from veritab.operators.calibration import VERDICTS
from veritab.operators.gate import cause_rank, diagnose, reason_codes

KEY = ("record_id", "source_id")


def last_writer(rows: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """The latest row of each key, in the order of `seq`."""
    own = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*own), F.col(seq)).alias("_r")).select(*keys, "_r.*")


def qualified_id(source_id: Column, record_id: Column) -> Column:
    """A record's id with that of its source before it, always: a local id may itself begin like a source's. Without a source it stays as it is."""
    return F.concat_ws(":", source_id, record_id)


def ruling(verdict: Column) -> Column:
    """A ruling in its stored form, or null where it is none: blanks and case don't count."""
    said = F.lower(F.trim(verdict))
    return F.when(said.isin(*VERDICTS), said)


def resolve_upserts(new: DataFrame, accepted: DataFrame | None = None, key: str = "record_id", payload: str = "payload", seq: str = "seq") -> DataFrame:
    """`new` with outcome written, identical, or collision.

    An accepted row is never changed: the first payload of a key, stored or
    earlier in the batch, stands; the same payload again is no error, another
    one is a collision.
    """
    first = Window.partitionBy(key).orderBy(seq)
    out = new.withColumn("_first", F.first(payload).over(first)).withColumn("_n", F.row_number().over(first))
    if accepted is not None:
        held = accepted.select(F.col(key).alias("_key"), F.col(payload).alias("_held"))
        out = out.join(held, F.col(key) == F.col("_key"), "left").drop("_key")
    else:
        out = out.withColumn("_held", F.lit(None).cast("string"))
    standing = F.coalesce("_held", "_first")
    fresh = F.col("_held").isNull() & (F.col("_n") == 1)
    return out.withColumn("outcome", F.when(fresh, "written").when(F.col(payload) == standing, "identical").otherwise("collision")).drop("_first", "_n", "_held")


def writable(gated: DataFrame, lane: Sequence[str] = ()) -> DataFrame:
    """What of gated records may be written: payload without the fields of the review lane, held (their names), qualified record_id, and refused (null, or why not).

    `gated`: record_id, source_id, entity_type, allowed, and fields (array of
    structs with field_name, value and source_id). Lane fields didn't block the
    gate because they aren't part of the row; a record of nothing else is
    refused, as is one whose fields cite several sources, since a record belongs
    to one.
    """
    lane = list(lane)
    kept = F.filter("fields", lambda f: ~f["field_name"].isin(lane)) if lane else F.col("fields")
    names = F.transform(F.filter("fields", lambda f: f["field_name"].isin(lane)), lambda f: f["field_name"]) if lane else F.expr("cast(array() as array<string>)")
    out = gated.withColumn("_kept", kept).withColumn("held", names)
    cited = F.array_distinct(F.filter(F.transform("_kept", lambda f: f["source_id"]), lambda s: s.isNotNull() & (s != "")))
    out = out.withColumn("_cited", cited)
    refused = (
        F.when(~F.coalesce("allowed", F.lit(False)), "gate").when((F.size("fields") > 0) & (F.size("_kept") == 0), "every_field_in_lane").when(F.size("_cited") > 1, "several_sources")
        .when(F.coalesce(F.get("_cited", F.lit(0)), F.nullif(F.trim("source_id"), F.lit("")), F.lit("")) == "", "no_source")
    )
    body = F.to_json(F.struct("record_id", "entity_type", F.col("_kept").alias("fields")))
    source = F.coalesce(F.get("_cited", F.lit(0)), F.col("source_id"))
    return out.withColumn("refused", refused).withColumn("payload", body).withColumn("source_id", source).withColumn("record_id", qualified_id(source, F.col("record_id"))).drop("_kept", "_cited")


def accepted_view(records: DataFrame, route: str | None = None, status: str | None = None, entity_type: str | None = None, limit: int = 100) -> DataFrame:
    """Accepted rows, newest first, filtered by what is given."""
    for c, v in (("route", route), ("source_status", status), ("entity_type", entity_type)):
        if v is not None:
            records = records.where(F.col(c) == v)
    return records.orderBy(F.col("written_at").desc(), F.col("record_id")).limit(limit)


def valid_adjudications(rulings: DataFrame, seq: str) -> DataFrame:
    """Rulings with a known verdict, the latest for each record and source."""
    return last_writer(rulings.withColumn("verdict", ruling(F.col("verdict"))).where("verdict is not null"), KEY, seq)


def adjudications(rulings: DataFrame, candidates: DataFrame) -> DataFrame:
    """Each ruling with its candidate's score and decision (null where there is none) and the surface it came from."""
    held = candidates.select(*KEY, "composite", "decision")
    return rulings.join(held, list(KEY), "left").withColumn("surface", surface_of(F.col("adjudicator")) if "adjudicator" in rulings.columns else F.lit("unknown"))


def review_queue(candidates: DataFrame, rulings: DataFrame | None = None, source_id: str | None = None, order: str = "best", limit: int = 50) -> DataFrame:
    """Denied candidates without a ruling, best or worst first, or by root cause (needs reasons and fields); the limit comes after the sort."""
    denied = candidates.where("decision = 'denied'")
    if source_id is not None:
        denied = denied.where(F.col("source_id") == source_id)
    if rulings is not None:
        denied = denied.join(rulings.select(*KEY), list(KEY), "left_anti")
    if order == "root_cause":
        d = diagnose(F.col("reasons"), F.col("fields"))
        ranked = denied.withColumn("_d", d).withColumn("cause_rank", cause_rank(F.col("_d.root"))).withColumn("open_questions", F.size("_d.independent")).withColumn("root", F.col("_d.root")).drop("_d")
        return ranked.orderBy("cause_rank", "open_questions", "source_id", "record_id").limit(limit)
    score = F.col("composite").desc_nulls_last() if order == "best" else F.col("composite").asc_nulls_first()
    return denied.orderBy(score, "source_id", "record_id").limit(limit)


def focus(candidates: DataFrame) -> DataFrame:
    """Candidates that the judge supports and the gate still holds back."""
    return candidates.where("judge_verdict = 'supported' and decision <> 'allowed'")


def check_queue(candidates: DataFrame, accepted: DataFrame, rulings: DataFrame, kind: str = "held") -> DataFrame:
    """The checking page: held, accepted or checked rows; accepted ones that have no candidate row join in. Supported first among held ones."""
    rest = accepted.join(candidates.select(*KEY), list(KEY), "left_anti").withColumn("decision", F.lit("allowed"))
    both = candidates.unionByName(rest, allowMissingColumns=True).join(rulings.select(*KEY, F.col("verdict").alias("ruling")), list(KEY), "left")
    if kind == "checked":
        return both.where("ruling is not null").orderBy("source_id", "record_id")
    if kind == "accepted":
        return both.where("ruling is null and decision = 'allowed'").orderBy("source_id", "record_id")
    held = both.where("ruling is null and decision <> 'allowed'")
    return held.orderBy((F.coalesce(F.col("judge_verdict"), F.lit("")) != "supported").cast("int"), "source_id", "record_id")


def source_links(doi: Column, pmcid: Column, pmid: Column) -> Column:
    """Where a source can be read: (kind, url) of each identifier it has."""
    rows = [("doi", "https://doi.org/", doi), ("pmcid", "https://pmc.ncbi.nlm.nih.gov/articles/", pmcid), ("pmid", "https://pubmed.ncbi.nlm.nih.gov/", pmid)]
    made = [F.when(F.coalesce(F.trim(c), F.lit("")) != "", F.struct(F.lit(k).alias("kind"), F.concat(F.lit(u), F.trim(c)).alias("url"))) for k, u, c in rows]
    return F.filter(F.array(*made), lambda x: x.isNotNull())


def why_short(reasons: Column, review_reasons: Column, note: Column) -> Column:
    """Codes, the extractor's own reasons and the judge's note, in that order, each once."""
    told = F.concat(reason_codes(reasons), F.coalesce(review_reasons, F.expr("cast(array() as array<string>)")), F.array(note))
    return F.array_distinct(F.filter(told, lambda r: r.isNotNull() & (r != "")))


def claim_text(fields: Column) -> Column:
    """A record in one line: name = value of each field that has one."""
    told = F.filter(fields, lambda f: f["value"].isNotNull())
    return F.array_join(F.transform(told, lambda f: F.concat(f["field_name"], F.when(F.lower(F.trim(f["value"])) == "not reported", F.lit(": not reported")).otherwise(F.concat(F.lit(" = "), f["value"])))), "; ")


def wide_fields(fields: DataFrame, keys: Sequence[str], names: Sequence[str] | None = None) -> DataFrame:
    """One row a record, one column a field, in the order in which fields first occur (`ord`); the first value of a repeated field stands.

    Without `names`, field names are listed first: as many as the schema has.
    """
    if names is None:
        names = [r["field_name"] for r in fields.groupBy("field_name").agg(F.min("ord").alias("o")).orderBy("o", "field_name").collect()]
    return fields.groupBy(*keys).agg(*[F.min_by(F.when(F.col("field_name") == n, F.col("value")), F.when(F.col("field_name") == n, F.col("ord"))).alias(n) for n in names])


def export_csv(wide: DataFrame, path: str, one_file: bool = True) -> None:
    """Write a wide table as CSV with a header."""
    (wide.coalesce(1) if one_file else wide).write.mode("overwrite").option("header", True).csv(path)


def theme_groups(claims: DataFrame, themes: DataFrame) -> DataFrame:
    """Claims and sources of each theme; claims without a theme, or with one that isn't declared, are unassigned."""
    named = claims.join(themes.select(F.col("theme").alias("_t")), F.col("theme") == F.col("_t"), "left")
    return named.groupBy(F.coalesce("_t", F.lit("unassigned")).alias("theme")).agg(F.count("*").alias("n_claims"), F.countDistinct("source_id").alias("n_sources"))
