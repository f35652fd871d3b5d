"""Queries of stores, table sidecars, page lines, lookups, usage rows, grounding of names, and replay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veritab.functions.grounding import ground_literature, judge_verdicts, lexical_score
from veritab.operators import accounting
from veritab.operators.gate import Policy, reason_codes
from veritab.operators.graph import checkpointed
from veritab.operators.merge import Identity
from veritab.plans import replay
from veritab.plans.inputs import laid_parts, table
from veritab.plans.registry import query
from veritab.sources import artifacts, pages, sidecar, stores


@query(
    "abstract_stores",
    """WITH p AS (SELECT CAST(doc_id AS STRING) AS source_id, trim(split_part(text, chr(10), 1)) AS t, CASE WHEN strpos(text, chr(10)) > 0 THEN trim(substr(text, strpos(text, chr(10)) + 1)) ELSE '' END AS a FROM documents),
s AS (SELECT source_id, t, a, CASE WHEN t <> '' THEN t || chr(10) || chr(10) ELSE '' END AS tb, CASE WHEN a <> '' THEN a || chr(10) || chr(10) ELSE '' END AS ab FROM p)
SELECT source_id, md5(tb || ab) AS text_md5, length(tb || ab)::INT AS chars, round_even(length(tb || ab) / 4.0, 0)::INT AS est_tokens, CASE WHEN a <> '' THEN length(tb)::INT END AS abstract_start, CASE WHEN a <> '' THEN (length(tb) + length(a))::INT END AS abstract_end FROM s WHERE tb || ab <> ''""",
)
def abstract_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stores of a title and an abstract: first line and rest of each document."""
    has = F.locate("\n", F.col("text")) > 0
    papers = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("source_id"), F.substring_index("text", "\n", 1).alias("title"), F.when(has, F.expr("substring(text, locate('\n', text) + 1)")).alias("abstract"))
    out = stores.abstract_stores(papers).where("error is null")
    return out.select("source_id", F.md5(F.col("full_text").cast("binary")).alias("text_md5"), "chars", "est_tokens", F.get("sections", F.lit(0))["start"].alias("abstract_start"), F.get("sections", F.lit(0))["end"].alias("abstract_end"))


def _tag(name: str, body: str) -> str:
    return f"<{name}>{body}</{name}>"


def _escaped(text: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


@query(
    "xml_stores",
    r"""WITH l AS (SELECT doc_id, i, trim(regexp_replace(line, '[ \t\r]+', ' ', 'g')) AS line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)),
t AS (SELECT doc_id, 'Body' || chr(10) || chr(10) || coalesce(string_agg(line || chr(10) || chr(10), '' ORDER BY i) FILTER (line <> ''), '') AS text FROM l GROUP BY doc_id)
SELECT CAST(doc_id AS STRING) AS source_id, md5(text) AS text_md5, length(text)::INT AS chars, 'Body' AS first_section, length(text)::INT AS section_end FROM t""",
)
def xml_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stores of full-text XML: each document as one section with a paragraph a line, and a reference list that is left out."""
    body = F.array_join(F.transform(F.split(_escaped(F.col("text")), "\n"), lambda x: F.concat(F.lit("<p>"), x, F.lit("</p>"))), "")
    xml = F.concat(F.lit('<article xmlns="urn:x"><body><sec><title>Body</title>'), body, F.lit("</sec></body>" + _tag("back", _tag("ref-list", _tag("ref", "left out"))) + "</article>"))
    out = stores.xml_stores(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("source_id"), xml.alias("xml")))
    first = F.get("sections", F.lit(0))
    return out.select("source_id", F.md5(F.col("full_text").cast("binary")).alias("text_md5"), "chars", first["title"].alias("first_section"), first["end"].alias("section_end"))


def _table_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table for each nation: customers with balances, every third of which wears a footnote."""
    cell = F.concat(F.col("c_acctbal").cast("int").cast("string"), F.when(F.col("c_custkey") % 3 == 0, "a").otherwise(""))
    row = F.struct("c_custkey", F.concat(F.lit("<tr><td>"), F.col("c_name"), F.lit("</td><td>"), cell, F.lit("</td></tr>")).alias("x"))
    rows = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(row)), lambda r: r["x"]), "").alias("x"))
    xml = F.concat(F.lit('<article><table-wrap id="t"><label>Table 1</label><table><tr><th colspan="2">Customers</th></tr><tr><th>Name</th><th>Balance</th></tr>'), "x", F.lit("</table>" + _tag("table-wrap-foot", _tag("fn", _tag("label", "a") + _tag("p", "Estimated."))) + "</table-wrap></article>"))
    return rows.select(F.col("c_nationkey").cast("string").alias("source_id"), xml.alias("xml"))


@query(
    "table_cells",
    r"""SELECT CAST(c_nationkey AS STRING) AS source_id, (row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) + 1)::INT AS "row", t AS text,
  CASE WHEN c_custkey % 3 <> 0 THEN t WHEN regexp_full_match(b, '[0-9]{1,2}') THEN t ELSE b END AS value_text, CASE WHEN c_custkey % 3 <> 0 THEN 'none' WHEN regexp_full_match(b, '[0-9]{1,2}') THEN 'ambiguous' ELSE 'typographic' END AS marker_source
FROM (SELECT *, CAST(trunc(c_acctbal)::INT AS STRING) AS b, CAST(trunc(c_acctbal)::INT AS STRING) || CASE WHEN c_custkey % 3 = 0 THEN 'a' ELSE '' END AS t FROM customer)""",
)
def table_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balances of the tables' grids, with the footnote markers taken off where they are sure."""
    return sidecar.table_cells(_table_xml(spark, sf_dir)).where("not is_header and col = 1").select("source_id", "row", "text", "value_text", "marker_source")


@query(
    "table_metrics",
    r"""WITH c AS (SELECT c_nationkey, c_custkey % 3 = 0 AS marked, c_custkey % 3 = 0 AND regexp_full_match(CAST(trunc(c_acctbal)::INT AS STRING), '[0-9]{1,2}') AS amb FROM customer)
SELECT CAST(c_nationkey AS STRING) AS source_id, (count(*) FILTER (marked AND NOT amb) > 0)::INT::DOUBLE AS footnote_resolution_rate, 0.0::DOUBLE AS recovered_label_share, 0.0::DOUBLE AS split_label_share,
  CASE WHEN count(*) FILTER (marked) > 0 THEN round(count(*) FILTER (amb)::DOUBLE / count(*) FILTER (marked), 9) END AS ambiguity_rate, CASE WHEN count(*) FILTER (marked AND NOT amb) > 0 THEN 1.0::DOUBLE END AS typographic_share, 1.0::DOUBLE AS header_chain_coverage FROM c GROUP BY c_nationkey""",
)
def table_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How well footnotes and headers of the tables resolve."""
    xml = _table_xml(spark, sf_dir)
    return sidecar.table_metrics(sidecar.table_cells(xml), sidecar.table_notes(xml)).withColumn("ambiguity_rate", F.round("ambiguity_rate", 9))


@query(
    "page_lines",
    """WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS t, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents),
n AS (SELECT doc_id, max(i) // 8 + 1 AS pages FROM l GROUP BY doc_id)
SELECT CAST(doc_id AS STRING) AS source_id, pages AS n_page_numbers FROM n WHERE pages >= 3""",
)
def page_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page numbers found in documents set on pages of eight lines, each under a number that counts on from 100."""
    lines = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("source_id"), F.posexplode(F.split("text", "\n")).alias("i", "text"))
    body = lines.select("source_id", (F.floor(F.col("i") / 8) + 1).cast("int").alias("page"), (F.col("i") % 8 + 1).cast("int").alias("line_no"), F.concat(F.lit("| "), "text").alias("text"))
    number = body.groupBy("source_id", "page").agg(F.lit(9).alias("line_no")).select("source_id", "page", "line_no", (F.col("page") + 100).cast("string").alias("text"))
    found = pages.running_lines(body.unionByName(number))
    return found.where("kind = 'page_number'").groupBy("source_id").agg(F.count("*").alias("n_page_numbers"))


@query("series_grounding", "SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN 'series_match' WHEN p_partkey % 4 = 1 THEN 'series_range_match' WHEN p_partkey % 4 = 2 THEN 'string_absent' ELSE 'interposed_match' END AS mode, CASE WHEN p_partkey % 4 = 2 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS score FROM part")
def series_grounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names that a quote gives as members of a series, of a range, or with words between their parts."""
    k = F.col("p_partkey") % 4
    value = F.when(k < 2, F.concat("p_name", F.lit(" B"))).when(k == 2, F.concat("p_name", F.lit(" F"))).otherwise(F.concat("p_name", F.lit(" NX-4")))
    quote = F.when((k == 0) | (k == 2), F.concat(F.lit("we call them "), "p_name", F.lit("s A (1), B and C"))).when(k == 1, F.concat(F.lit("all of "), "p_name", F.lit("s A-D were kept"))).otherwise(F.concat(F.lit("from "), "p_name", F.lit(", strain NX-4")))
    g = ground_literature(F.array(value), F.lit(False), quote)
    return table(spark, sf_dir, "part").select("p_partkey", g.alias("g")).select("p_partkey", "g.mode", "g.score")


@query(
    "lexical_grounding",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE l_partkey % 4 WHEN 0 THEN 'numeric_match' WHEN 1 THEN 'numeric_absent' WHEN 2 THEN 'string_match' ELSE 'no_quote' END AS mode, CASE WHEN l_partkey % 2 = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS score FROM lineitem",
)
def lexical_grounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers within a hundredth, and contained words, of values and quotes; no Python."""
    q = F.col("l_quantity").cast("int").cast("string")
    k = F.col("l_partkey") % 4
    value = F.when(k < 2, F.concat(q, F.lit(" kg"))).otherwise(F.concat(F.lit("flag  "), F.col("l_returnflag")))
    quote = F.when(k == 0, F.concat(F.lit("about "), q, F.lit(".2 units"))).when(k == 1, F.lit("about 7777 units")).when(k == 2, F.concat(F.lit("with FLAG "), F.col("l_returnflag"))).otherwise(F.lit(" "))
    near = F.when(k == 0, F.concat(F.lit("exactly "), q, F.lit(" units"))).otherwise(quote)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", lexical_score(value, near).alias("g")).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "g.mode", "g.score")


@query("judge_parse", "SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'supported' WHEN 1 THEN 'partial' WHEN 2 THEN 'unsupported' END AS verdict FROM orders")
def judge_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts in replies: by id, by place, in a sentence, and none."""
    rid = F.concat(F.lit("r"), F.col("o_orderkey").cast("string"))
    k = F.col("o_orderkey") % 4
    reply = F.when(k == 0, F.concat(F.lit('Here: ```json {"verdicts": [{"record_id": "'), rid, F.lit('", "verdict": "Supported"}]} ```'))).when(k == 1, F.lit('[{"verdict": "partial"}]')).when(k == 2, F.concat(F.lit("I find "), rid, F.lit(" to be unsupported by it."))).otherwise(F.lit("no idea"))
    v = judge_verdicts(reply, F.array(rid))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.get(v, F.lit(0))["verdict"].alias("verdict"))


@query(
    "lookup_resolution",
    "SELECT p.p_partkey, CASE count(s.s_suppkey) WHEN 0 THEN 'no_match' WHEN 1 THEN 'resolved' ELSE 'ambiguous' END AS state, least(count(s.s_suppkey), 10)::INT AS n_candidates FROM part p LEFT JOIN supplier s ON s.s_suppkey % 40 = p.p_partkey % 53 GROUP BY p.p_partkey",
)
def lookup_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names answered by a table: one hit resolves, several choose nothing."""
    names = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_partkey") % 53).cast("string").alias("name"))
    known = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") % 40).cast("string").alias("name"), F.lit("answered").alias("state"), "s_suppkey")
    return artifacts.resolve_names(names, known).select("p_partkey", "state", F.coalesce(F.size("candidates"), F.lit(0)).alias("n_candidates")).withColumn("n_candidates", F.greatest("n_candidates", F.lit(0)))


@query("usage_rows", "SELECT event_id, CASE WHEN event_id % 4 = 1 THEN 0 ELSE event_id % 90 END AS input, CASE WHEN event_id % 4 = 2 THEN 0 ELSE event_id % 30 END AS output, 0::BIGINT AS cache_read, CASE WHEN event_id % 4 = 3 THEN 0 ELSE 5 END::BIGINT AS cache_write FROM events")
def usage_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token streams under any of their names; negatives and words count nothing."""
    i, k = F.col("event_id"), F.col("event_id") % 4
    usage = F.concat(
        F.lit('{"input_tokens": '), F.when(k == 1, -i - 1).otherwise(i % 90).cast("string"), F.lit(', "completion_tokens": '), F.when(k == 2, F.lit('"many"')).otherwise((i % 30).cast("string")),
        F.lit(', "cache_creation_input_tokens": '), F.when(k == 3, "5.5").otherwise("5"), F.lit("}"),
    )
    return accounting.usage_rows(table(spark, sf_dir, "events").select("event_id", usage.alias("usage")))


def passes_of_orders(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """(records, fields, sources, partitions that all three lie in by source): orders as sources whose items were read in three passes; the third misreads some quantities."""
    read = table(spark, sf_dir, "lineitem")
    li = read.select(F.col("l_orderkey").cast("string").alias("source_id"), F.col("l_partkey").cast("string").alias("code"), F.col("l_quantity").cast("int").cast("string").alias("qty"), F.col("l_linenumber").alias("line"))
    # lines move once, by source, before they become passes and fields; as an array they have the same columns for all that is derived, which so shares the move.
    # A line without order or part has no field that a pass could be found by.
    lines = li.where("source_id is not null and code is not null").repartition(parts := laid_parts(read), "source_id").groupBy("source_id").agg(F.collect_list(F.struct("code", "qty", "line")).alias("l"))
    items = lines.select("source_id", F.explode("l").alias("l")).groupBy("source_id", F.col("l.code").alias("code")).agg(F.min("l.qty").alias("qty"), F.min("l.line").alias("line"))
    passes = items.withColumn("pass_ix", F.explode(F.sequence(F.lit(0), F.lit(2)))).withColumn("rec_ix", F.col("code").cast("int"))
    records = passes.select("source_id", "pass_ix", "rec_ix", F.concat(F.lit("r"), "code").alias("record_id"), F.lit("item").alias("entity_type"), F.lit(False).alias("review_only"), F.lit(None).cast("string").alias("review_reason"))
    quote = F.concat(F.lit("item "), "code", F.lit(" x "), "qty", F.lit(";"))
    said = F.when((F.col("pass_ix") == 2) & (F.col("line") % 3 == 0), F.lit("0")).otherwise(F.col("qty"))
    fields = passes.select("source_id", "pass_ix", "rec_ix", F.explode(F.array(F.struct(F.lit(0).alias("ord"), F.lit("code").alias("field_name"), F.col("code").alias("value")), F.struct(F.lit(1).alias("ord"), F.lit("qty").alias("field_name"), said.alias("value")))).alias("f"), quote.alias("quote"))
    text = items.groupBy("source_id").agg(F.array_join(F.array_sort(F.collect_list(quote)), " ").alias("text"))
    sources = text.withColumn("source_status", F.when(F.col("source_id").cast("int") % 10 == 0, "retracted").otherwise("active"))
    return records, fields.select("source_id", "pass_ix", "rec_ix", "f.*", "quote"), sources, parts


@query(
    "replay_records",
    """WITH li AS (SELECT CAST(l_orderkey AS VARCHAR) AS source_id, CAST(l_partkey AS VARCHAR) AS code, min(l_linenumber) AS line FROM lineitem GROUP BY 1, 2),
r AS (SELECT source_id, 'r' || code AS record_id, line % 3 = 0 AS misread, CAST(code AS INT) % 5 = 0 AS unsupported, CAST(source_id AS INT) % 10 = 0 AS retracted FROM li),
c AS (SELECT *, list_filter([CASE WHEN misread THEN 'composite_below_bar' END, CASE WHEN unsupported THEN 'judge' END, CASE WHEN retracted THEN 'source_status' END, CASE WHEN retracted THEN 'source_status' END], lambda x: x IS NOT NULL) AS codes FROM r)
SELECT source_id, record_id, CASE WHEN misread THEN (0.35::DOUBLE + 0.15::DOUBLE * (2.0::DOUBLE / 3)) / 0.5::DOUBLE ELSE 1.0::DOUBLE END AS composite, len(codes) = 0 AS allowed, array_to_string(codes, ',') AS codes FROM c""",
)
def replay_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as sources, read in three passes, merged, anchored, grounded, scored and gated; saved verdicts stand for the judge."""
    records, fields, sources, parts = passes_of_orders(spark, sf_dir)
    aligned, merged = replay.merged_records(records, fields, Identity.of("code"), 3, parts)
    ids = aligned.select("source_id", F.col("merged_id").alias("record_id"))
    verdicts = ids.withColumn("verdict", F.when(F.substring("record_id", 2, 20).cast("int") % 5 != 0, "supported").otherwise("partial"))
    none = spark.createDataFrame([], "source_id string, record_id string, field_name string")
    out = replay.gate_records(merged, sources, none, ids, verdicts, 3, Policy(), parts)
    return out.select("source_id", "record_id", "composite", "allowed", F.array_join(F.array_sort(reason_codes(F.col("reasons"))), ",").alias("codes"))
