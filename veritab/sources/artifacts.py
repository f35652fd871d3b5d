"""Saved artifacts: passes, replies, hits, run logs; lookups that answer by table instead of by network."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veritab.functions.text import log_seconds

RECORDS = "array<struct<record_id:string,entity_type:string,review_only:boolean,review_reason:string,fields:array<struct<field_name:string,value:string,verbatim_quote:string>>>>"


def read_passes(spark: SparkSession, root: str) -> DataFrame:
    """(source_id, pass_ix, rec_ix, record columns, fields) of pass files below a folder; the source is the folder of the pass's. One that can't be read is an empty pass."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "pass*.json").option("wholetext", True).text(root)
    path = F.split(F.col("_metadata.file_path"), "/")
    rows = files.select(F.element_at(path, -2).alias("source_id"), F.regexp_extract(F.element_at(path, -1), r"(\d+)", 1).try_cast("int").alias("pass_ix"), F.from_json("value", RECORDS).alias("r"))
    rows = rows.withColumn("source_id", F.when(F.col("source_id").rlike("^pass"), F.element_at(path, -3)).otherwise(F.col("source_id")))
    return rows.select("source_id", "pass_ix", F.posexplode("r").alias("rec_ix", "r")).select("source_id", "pass_ix", "rec_ix", "r.*")


def pass_fields(records: DataFrame) -> DataFrame:
    """Fields of pass records in long form, in order."""
    return records.select("source_id", "pass_ix", "rec_ix", F.posexplode("fields").alias("ord", "f")).select("source_id", "pass_ix", "rec_ix", "ord", "f.field_name", "f.value", F.col("f.verbatim_quote").alias("quote"))


HIT = "pmid string, pmcid string, doi string, title string, pubYear string, isOpenAccess string, inEPMC string, license string, journalInfo struct<journal:struct<title:string>>, pubTypeList struct<pubType:array<string>>, abstractText string"


def describe_hits(raw: DataFrame, column: str = "value") -> DataFrame:
    """Search hits (JSON) as rows: ids, title, year, journal, open access, lower-cased kinds, whether retracted and whether there is an abstract."""
    h = raw.select(F.from_json(column, HIT).alias("h"))
    kinds = F.transform(F.coalesce("h.pubTypeList.pubType", F.expr("cast(array() as array<string>)")), lambda t: F.lower(t))
    return h.select(
        "h.pmid", "h.pmcid", "h.doi", "h.title", F.col("h.pubYear").try_cast("int").alias("year"), F.col("h.journalInfo.journal.title").alias("journal"), (F.coalesce("h.isOpenAccess", F.lit("N")) == "Y").alias("open_access"),
        "h.license", kinds.alias("kinds"), F.exists(kinds, lambda k: k.contains("retract")).alias("retracted"), (F.coalesce(F.trim("h.abstractText"), F.lit("")) != "").alias("has_abstract"),
    )


def preview(hits: DataFrame, titles: int = 10) -> DataFrame:
    """One row: counts of a search, and its first titles in order of `ord`."""
    first = F.slice(F.transform(F.array_sort(F.collect_list(F.when(F.col("ord") < titles, F.struct("ord", "title")))), lambda t: t["title"]), 1, titles)
    return hits.agg(F.count("*").alias("n"), F.count_if("open_access").alias("n_open"), F.count_if("has_abstract").alias("n_abstract"), F.count_if("retracted").alias("n_retracted"), first.alias("titles"))


def scan_log(spark: SparkSession, path: str) -> DataFrame:
    """(paper, first_s, last_s, n_done, n_failed, n_limited) of run logs: lines "HH:MM:SS [paper] message"."""
    lines = spark.read.text(path)
    rows = lines.select(log_seconds(F.regexp_extract("value", r"^(\d{1,2}:\d{2}:\d{2})", 1)).alias("s"), F.regexp_extract("value", r"\[([^\]]+)\]", 1).alias("paper"), F.lower("value").alias("text")).where("paper <> ''")
    has = lambda p: F.count_if(F.col("text").rlike(p))
    return rows.groupBy("paper").agg(F.min("s").alias("first_s"), F.max("s").alias("last_s"), has(r"\bdone\b").alias("n_done"), has(r"\b(?:failed|error)\b").alias("n_failed"), has(r"\b(?:limit|quota)\b").alias("n_limited"))


#: Signatures of failures; the first that fits counts.
SIGNATURES = (("timeout", r"timed? ?out"), ("limit", r"\b(?:rate|usage) limit|quota"), ("parse", r"json|parse"), ("network", r"connection|network|unreachable"))


def signature(text: Column) -> Column:
    """The kind of a failure, or other."""
    out = F.lit("other")
    for name, pattern in reversed(SIGNATURES):
        out = F.when(F.lower(text).rlike(pattern), name).otherwise(out)
    return out


def upper_middle(values: Column) -> Column:
    """The element at n div 2 of the sorted values: the upper one of two middle ones."""
    return F.get(F.sort_array(values), F.floor(F.size(values) / 2).cast("int"))


def post_mortem(log: DataFrame) -> DataFrame:
    """One row: papers, completed ones, upper-middle duration and the five slowest."""
    took = log.withColumn("took", F.col("last_s") - F.col("first_s"))
    slow = F.slice(F.transform(F.reverse(F.array_sort(F.collect_list(F.struct("took", "paper")))), lambda x: x["paper"]), 1, 5)
    return took.agg(F.count("*").alias("n"), F.count_if(F.col("n_done") > 0).alias("n_done"), upper_middle(F.collect_list("took")).alias("median_s"), slow.alias("slowest"))


def resolve_names(names: DataFrame, authority: DataFrame, name: str = "name", keep: int = 10) -> DataFrame:
    """Names answered by a lookup table (name, state, and columns): resolved for one hit, ambiguous (with up to ten candidates and nothing chosen) for more, else no_match, or unreachable where the lookup says so."""
    own = [c for c in authority.columns if c not in (name, "state")]
    hits = authority.groupBy(name).agg(F.count_if(F.col("state") == "answered").alias("_n"), F.max(F.col("state") == "unreachable").alias("_down"), F.slice(F.array_sort(F.collect_list(F.when(F.col("state") == "answered", F.struct(*own)))), 1, keep).alias("candidates"))
    out = names.join(hits, name, "left")
    state = F.when(F.col("_n") == 1, "resolved").when(F.col("_n") > 1, "ambiguous").when(F.coalesce("_down", F.lit(False)), "unreachable").otherwise("no_match")
    return out.withColumn("state", state).withColumn("resolved", F.when(F.col("_n") == 1, F.get("candidates", F.lit(0)))).drop("_n", "_down")


def resolve_rungs(names: DataFrame, authority: DataFrame, key: str = "name") -> DataFrame:
    """The first candidate (array column `candidates`, best first) that the authority (candidate, taxon) knows."""
    long = names.select(key, F.posexplode("candidates").alias("rung", "candidate"))
    hit = long.join(authority, "candidate").groupBy(key).agg(F.min(F.struct("rung", "candidate", "taxon")).alias("h"))
    return names.join(hit, key, "left").select(*names.columns, F.col("h.rung").alias("rung"), F.col("h.candidate").alias("matched"), F.col("h.taxon").alias("taxon"))


def same_organism(a: Column, b: Column) -> Column:
    """Whether two resolved taxa are one; unknown unless both are resolved."""
    return F.when(a.isNotNull() & b.isNotNull(), a == b)


def authority_fields(resolved: DataFrame, keys: list[str], columns: list[str], mode: str = "authority_resolved") -> DataFrame:
    """Resolved columns as field rows; nulls give none."""
    long = resolved.select(*keys, F.explode(F.array(*[F.struct(F.lit(c).alias("field_name"), F.col(c).cast("string").alias("value")) for c in columns])).alias("f"))
    return long.where("f.value is not null").select(*keys, "f.*", F.lit(mode).alias("grounding_mode"), F.lit(1.0).alias("c_grounded"))
