"""Queries of sinks, streams, saved artifacts, enrichment, and the state of a project."""

from __future__ import annotations

import json
import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veritab.operators import accounting, corpus, graph, reports, selection, sets, spans
from veritab.plans import replay, spec
from veritab.plans.inputs import table
from veritab.plans.queries_corpus import _papers
from veritab.plans.queries_rules import expected, given
from veritab.plans.queries_sources import passes_of_orders
from veritab.plans.registry import oracle_of, query
from veritab.sources import artifacts, search, stores
from veritab.sources.tables import OutputTables
from veritab.streaming import ingest


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the session's shared checkpoint folder."""
    return f"{graph.shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def put(spark: SparkSession, path: str, text: str) -> None:
    """Write one small file by the session's file system."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(conf).create(target)
    out.write(bytearray(text.encode()))
    out.close()


_GATED = """SELECT o_orderkey AS seq, 's' || CAST(o_custkey % 7 AS VARCHAR(20)) AS source_id, 'r' || CAST(o_orderkey % 200 AS VARCHAR(20)) AS local_id, o_orderstatus AS status, o_orderkey % 3 <> 0 AS allowed, o_orderkey % 11 = 0 AS lane_only, o_orderkey % 13 = 0 AS two FROM orders"""


@query(
    "gated_upsert",
    f"""WITH g AS ({_GATED}), r AS (SELECT *, source_id || ':' || local_id AS record_id, CASE WHEN NOT allowed THEN 'gate' WHEN lane_only THEN 'every_field_in_lane' WHEN two THEN 'several_sources' END AS refused FROM g),
w AS (SELECT *, first_value(status) OVER o AS standing, row_number() OVER o AS k FROM r WHERE refused IS NULL WINDOW o AS (PARTITION BY record_id ORDER BY seq))
SELECT seq, record_id, CAST(NULL AS VARCHAR) AS refused, CASE WHEN k = 1 THEN 'written' WHEN status = standing THEN 'identical' ELSE 'collision' END AS outcome FROM w
UNION ALL SELECT seq, record_id, refused, 'denied' FROM r WHERE refused IS NOT NULL""",
)
def gated_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches through the write gate: fields of the review lane aren't written, records of nothing else or of several sources are refused, accepted rows never change."""
    table(spark, sf_dir, "orders").createOrReplaceTempView("_gated_orders")
    g = spark.sql(_GATED.replace("FROM orders", "FROM _gated_orders"))
    field = lambda name, value, source: F.struct(F.lit(name).alias("field_name"), value.alias("value"), source.alias("source_id"))
    own, note = field("status", F.col("status"), F.col("source_id")), field("note", F.lit("long prose"), F.lit("elsewhere"))
    fields = F.when(F.col("lane_only"), F.array(note)).when(F.col("two"), F.array(own, field("other", F.lit("x"), F.lit("another source")), note)).otherwise(F.array(own, note))
    rows = g.select(
        "seq", "source_id", F.col("local_id").alias("record_id"), F.lit("order").alias("entity_type"), "allowed", fields.alias("fields"), F.lit("auto_accept").alias("route"), F.lit("active").alias("source_status"), F.lit(1.0).alias("composite"), F.lit("2024-01-01").alias("written_at")
    )
    tables, half = OutputTables(spark, scratch(spark, "tables")), rows.agg(F.max("seq")).first()[0] // 2
    first = tables.upsert(rows.where(F.col("seq") <= half), ("note",))
    return first.unionByName(tables.upsert(rows.where(F.col("seq") > half), ("note",))).select("seq", "record_id", "refused", "outcome")


_RULINGS = "SELECT o_orderkey AS seq, 'r' || CAST(o_custkey AS VARCHAR(20)) AS record_id, 's' || CAST(o_custkey % 5 AS VARCHAR(20)) AS source_id, CASE o_orderkey % 5 WHEN 0 THEN ' Right' WHEN 1 THEN 'WRONG ' WHEN 2 THEN 'cant_tell' WHEN 3 THEN 'maybe' END AS verdict FROM orders"


@query("adjudication_sink", f"WITH r AS (SELECT seq, record_id, source_id, lower(trim(verdict)) AS verdict FROM ({_RULINGS})) SELECT record_id, source_id, arg_max(verdict, seq) AS verdict, max(seq) AS seq FROM r WHERE verdict IN ('right', 'wrong', 'cant_tell') GROUP BY record_id, source_id")
def adjudication_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rulings as they are stored: trimmed, in lower case, the latest of each record; unknown ones are refused."""
    table(spark, sf_dir, "orders").createOrReplaceTempView("_ruled_orders")
    rows = spark.sql(_RULINGS.replace("FROM orders", "FROM _ruled_orders")).withColumns({"note": F.lit(""), "adjudicator": F.lit("ann [chat]"), "at": F.lit("2024-01-01")})
    tables = OutputTables(spark, scratch(spark, "tables"))
    for odd in (1, 0):
        tables.record_adjudications(rows.where(F.col("seq") % 2 == odd))
    return tables.adjudications().select("record_id", "source_id", "verdict", "seq")


@query("candidate_sink", "SELECT 'r' || CAST(o_custkey % 50 AS VARCHAR) AS record_id, 's' AS source_id, arg_max(o_orderstatus, o_orderkey) AS decision, arg_max(o_totalprice, o_orderkey) AS composite FROM orders WHERE o_custkey % 50 = 7 GROUP BY 1")
def candidate_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates, whatever the gate said, replaced by their latest row; one of them looked up by its key."""
    o = table(spark, sf_dir, "orders")
    rows = o.select(F.concat(F.lit("r"), (F.col("o_custkey") % 50).cast("string")).alias("record_id"), F.lit("s").alias("source_id"), F.lit("order").alias("entity_type"), F.col("o_totalprice").alias("composite"), F.col("o_orderstatus").alias("decision"), F.array(F.lit("judge")).alias("codes"), F.lit("partial").alias("judge_verdict"), F.lit("{}").alias("payload"), F.lit("2024-01-01").alias("recorded_at"), F.col("o_orderkey").alias("seq"))
    tables = OutputTables(spark, scratch(spark, "tables"))
    tables.record_candidates(rows)
    return reports.candidate(tables.candidates(), "r7", "s").select("record_id", "source_id", "decision", "composite")


@query("store_round_trip", "SELECT CAST(d.doc_id AS VARCHAR) AS source_id, true AS stored, length(text || chr(10) || chr(10))::INT AS chars FROM documents d WHERE trim(text) <> '' UNION ALL SELECT CAST(doc_id + 1000000000 AS VARCHAR), false, NULL FROM documents")
def store_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stores written and read back by id; an id that was never stored has no text."""
    d = table(spark, sf_dir, "documents").where(F.trim("text") != "")
    path = scratch(spark, "stores")
    whole = d.select(F.col("doc_id").cast("string").alias("source_id"), F.concat("text", F.lit("\n\n")).alias("full_text"), F.expr("cast(array() as array<struct<title:string,start:int,end:int,depth:int>>)").alias("sections"), (F.length("text") + 2).alias("chars"), F.lit(0).alias("est_tokens"), F.lit(None).cast("string").alias("error"))
    stores.write_stores(whole, path)
    ids = whole.select("source_id").unionByName(table(spark, sf_dir, "documents").select((F.col("doc_id") + 1_000_000_000).cast("string").alias("source_id")))
    return stores.find_store(ids, spark.read.parquet(path)).select("source_id", F.col("full_text").isNotNull().alias("stored"), F.length("full_text").alias("chars"))


def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a stream of its files."""
    shape = table(spark, sf_dir, name).schema
    return ingest.read_stream(spark, f"{sf_dir}/{name[:-1]}[{name[-1]}].parquet", shape)


@query("stream_first_seen", "SELECT DISTINCT user_id, event_type FROM events")
def stream_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of a stream, each kept the first time that it comes within the watermark."""
    seen = ingest.first_seen(_stream(spark, sf_dir, "events").select("user_id", "event_type", "ts"), ["user_id", "event_type"], "ts", "3650 days")
    to = scratch(spark, "seen")
    ingest.run_available(seen, scratch(spark, "stream"), lambda batch, _: batch.write.mode("append").parquet(to))
    return spark.read.schema("user_id long, event_type string, ts timestamp").parquet(to).select("user_id", "event_type")


@query("stream_windows", "SELECT CAST(date_trunc('hour', ts) AS VARCHAR) AS hour, event_type AS stage, count(*) AS calls, sum(event_id % 100)::BIGINT AS tokens FROM events GROUP BY 1, 2")
def stream_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls and tokens by stage in windows of an hour, as a stream adds them up."""
    rows = _stream(spark, sf_dir, "events").select("ts", F.col("event_type").alias("stage"), (F.col("event_id") % 100).alias("tokens"))
    to = scratch(spark, "windows")
    ingest.run_available(ingest.windowed_usage(rows), scratch(spark, "stream"), lambda batch, _: batch.write.mode("overwrite").parquet(to), mode="complete")
    return spark.read.parquet(to).select(F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("hour"), "stage", "calls", "tokens")


@query("stream_upserts", f"WITH n AS (SELECT *, row_number() OVER (PARTITION BY source_id, local_id ORDER BY seq) AS k FROM ({_GATED}) WHERE allowed) SELECT source_id || ':' || local_id AS record_id, status AS payload, seq FROM n WHERE k = 1")
def stream_upserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted rows after a stream was gated and written, resumed with nothing left to do, and delivered once more from the start."""
    rows = _stream(spark, sf_dir, "orders")
    shaped = rows.select(
        F.col("o_orderkey").alias("seq"), F.concat(F.lit("s"), (F.col("o_custkey") % 7).cast("string")).alias("source_id"), F.concat(F.lit("r"), (F.col("o_orderkey") % 200).cast("string")).alias("record_id"), F.lit("order").alias("entity_type"), F.lit("auto_accept").alias("route"),
        F.lit("active").alias("source_status"), F.lit(1.0).alias("composite"), F.col("o_orderstatus").alias("payload"), F.lit("2024-01-01").alias("written_at"),
    )
    tables = OutputTables(spark, scratch(spark, "tables"))
    once, again = scratch(spark, "stream"), scratch(spark, "stream")
    for at in (once, once, again):
        ingest.upsert_stream(shaped, tables, at, lambda batch: batch.withColumn("allowed", F.col("seq") % 3 != 0))
    return tables.records().select("record_id", "payload", "seq")


_CEILINGS = [("tokens", 3, 60, "tokens"), ("calls", 2, 40, "calls"), ("none", 4, 100, None)]


@query("stream_fuse", expected("ceiling string, calls int, tokens int, tripped string", _CEILINGS))
def stream_fuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of twenty, twenty, twenty and forty tokens under ceilings: one that passes a ceiling isn't run."""
    batches = [spark.range(10).select((F.col("id") * 0 + n).alias("tokens")) for n in (2, 2, 2, 4)]
    out = []
    for name, fuse in (("tokens", accounting.Fuse(9, 70)), ("calls", accounting.Fuse(2, 1000)), ("none", accounting.Fuse.from_environment({"VERITAB_MAX_CALLS": "9", "VERITAB_MAX_TOKENS": "no number"}))):
        ran: list[int] = []
        each = ingest.fused(lambda batch, k, ran=ran: ran.append(batch.count() * batch.first()["tokens"]), fuse)
        tripped = None
        try:
            for k, batch in enumerate(batches):
                each(batch, k)
        except accounting.FuseExceeded as why:
            tripped = why.what
        out.append((name, len(ran), sum(ran), tripped))
    return given(spark, "ceiling string, calls int, tokens int, tripped string", out)


@query("resume_pending", "SELECT o_custkey AS source_id FROM orders GROUP BY o_custkey HAVING count(*) FILTER (o_orderstatus = 'F' OR o_orderpriority = '5-LOW') = 0")
def resume_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources still to do: a recorded negative is finished, a run with a skipped stage isn't."""
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("source_id"), F.when(F.col("o_orderstatus") == "F", "done").when(F.col("o_orderpriority") == "5-LOW", "empty").otherwise("incomplete").alias("state"))
    return ingest.pending(o.select("source_id").distinct(), o)


@query(
    "project_progress",
    """SELECT state, count(*) AS n FROM (SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'no_store' WHEN max(o_orderkey) IS NULL THEN 'to_do' ELSE arg_max(CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'incomplete' ELSE 'error' END, o_orderkey) END AS state
FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey) GROUP BY state""",
)
def project_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of a project are: not stored, to do, or the state of their latest run."""
    papers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("source_id"))
    runs = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("source_id"), F.expr("CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'incomplete' ELSE 'error' END").alias("state"), F.col("o_orderkey").alias("seq"))
    return reports.progress(papers, papers.where("source_id % 4 <> 0"), runs).groupBy("state").agg(F.count("*").alias("n"))


@query(
    "saved_passes",
    """SELECT 'n' || CAST(n_nationkey AS VARCHAR) AS source_id, p::INT AS pass_ix, 0 AS rec_ix, 'r1' AS record_id, f AS field_name, CASE WHEN f = 'name' THEN n_name ELSE CAST(n_regionkey AS VARCHAR) END AS value, 'in ' || n_name AS quote, i::INT AS ord
FROM nation, range(0, 2) a(p), (VALUES (0, 'name'), (1, 'region')) v(i, f) WHERE NOT (n_nationkey % 5 = 0 AND p = 1)""",
)
def saved_passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of passes saved as JSON files, a folder a source; a file that can't be read is an empty pass."""
    root = scratch(spark, "passes")
    for r in table(spark, sf_dir, "nation").collect():  # a file each for a handful of fixtures
        for k in range(2):
            fields = [{"field_name": n, "value": str(v), "verbatim_quote": f"in {r['n_name']}"} for n, v in (("name", r["n_name"]), ("region", r["n_regionkey"]))]
            text = json.dumps([{"record_id": "r1", "entity_type": "nation", "fields": fields}]) if k == 0 or r["n_nationkey"] % 5 else "[{cut off"
            put(spark, f"{root}/n{r['n_nationkey']}/pass{k}.json", text)
    return artifacts.pass_fields(artifacts.read_passes(spark, root)).join(artifacts.read_passes(spark, root).select("source_id", "pass_ix", "rec_ix", "record_id"), ["source_id", "pass_ix", "rec_ix"])


_LOG = "SELECT CAST(o_custkey AS VARCHAR(20)) AS paper, CAST(o_orderkey % 80000 AS BIGINT) AS s, CASE o_orderstatus WHEN 'F' THEN 'done in time' WHEN 'P' THEN 'FAILED: usage limit' ELSE 'reading' END AS said FROM orders"


def _log(spark: SparkSession, sf_dir: str) -> str:
    table(spark, sf_dir, "orders").createOrReplaceTempView("_log_orders")
    rows = spark.sql(_LOG.replace("FROM orders", "FROM _log_orders"))
    clock = F.concat_ws(":", *[F.lpad((e % m).cast("string"), 2, "0") for e, m in ((F.expr("s div 3600"), 24), (F.expr("s div 60"), 60), (F.col("s"), 60))])
    path = scratch(spark, "log")
    rows.select(F.concat(clock, F.lit(" ["), "paper", F.lit("] "), "said").alias("value")).unionByName(spark.range(1).select(F.lit("a line without a paper").alias("value"))).write.text(path)
    return path


@query("run_log", f"SELECT paper, min(s)::INT AS first_s, max(s)::INT AS last_s, count(*) FILTER (said LIKE 'done%') AS n_done, count(*) FILTER (said LIKE 'FAILED%') AS n_failed, count(*) FILTER (said LIKE 'FAILED%') AS n_limited FROM ({_LOG}) GROUP BY paper")
def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First and last sight of each paper in run logs, and how it went."""
    return artifacts.scan_log(spark, _log(spark, sf_dir))


@query(
    "run_post_mortem",
    f"""WITH p AS (SELECT paper, (max(s) - min(s))::INT AS took, count(*) FILTER (said LIKE 'done%') AS n_done FROM ({_LOG}) GROUP BY paper)
SELECT count(*) AS n, count(*) FILTER (n_done > 0) AS n_done, (SELECT took FROM p ORDER BY took LIMIT 1 OFFSET (SELECT count(*) // 2 FROM p)) AS median_s, (SELECT string_agg(paper, ',' ORDER BY took DESC, paper DESC) FROM (SELECT * FROM p ORDER BY took DESC, paper DESC LIMIT 5)) AS slowest FROM p""",
)
def run_post_mortem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run in one row: papers, completed ones, the upper middle duration, the five slowest."""
    return artifacts.post_mortem(artifacts.scan_log(spark, _log(spark, sf_dir))).withColumn("slowest", F.array_join("slowest", ","))


_KINDS = [("Call TIMED OUT after 60 s", "timeout"), ("usage limit reached", "limit"), ("could not parse JSON", "parse"), ("connection reset", "network"), ("something else", "other"), ("quota and timeout", "timeout")]


@query("error_signatures", "WITH k AS (SELECT unnest(['timeout', 'limit', 'parse', 'network', 'other', 'timeout']) AS signature, unnest(range(0, 6)) AS m) SELECT signature, count(*) AS n FROM orders JOIN k ON o_orderkey % 6 = m GROUP BY signature")
def error_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failures by kind; the first signature that fits counts."""
    said = F.get(F.array(*[F.lit(t) for t, _ in _KINDS]), (F.col("o_orderkey") % 6).cast("int"))
    return table(spark, sf_dir, "orders").groupBy(artifacts.signature(said).alias("signature")).agg(F.count("*").alias("n"))


def _getter(query_: str, cursor: str | None) -> tuple[list[dict], str | None]:
    """Ten hits a page; the cursor of the last page comes again."""
    at = int(cursor or 0)
    hits = [
        {"pmid": str(k), "doi": f"10.1/{k}", "title": f"{query_} {k}", "pubYear": str(2000 + k % 20), "isOpenAccess": "Y" if k % 2 else "N", "journalInfo": {"journal": {"title": "J"}}, "pubTypeList": {"pubType": ["Retracted Publication" if k % 7 == 0 else "research-article"]}, "abstractText": "" if k % 3 == 0 else "words"}
        for k in range(at, min(at + 10, 120))
    ]
    return hits, str(min(at + 10, 120))


def _found(spark: SparkSession) -> DataFrame:
    spark.dataSource.register(search.search_source(_getter))
    raw = spark.read.format("veritab_search").option("query", "title").option("limit", 95).load()
    return artifacts.describe_hits(raw).withColumn("ord", F.col("pmid").cast("int"))


@query("search_hits", "SELECT CAST(k AS VARCHAR) AS pmid, 'title ' || CAST(k AS VARCHAR) AS title, (2000 + k % 20)::INT AS \"year\", 'J' AS journal, k % 2 = 1 AS open_access, k % 7 = 0 AS retracted, k % 3 <> 0 AS has_abstract FROM range(0, 95) r(k)")
def search_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits of a literature search behind a getter that pages by cursor, up to a limit."""
    return _found(spark).select("pmid", "title", "year", "journal", "open_access", "retracted", "has_abstract")


@query("search_preview", "SELECT count(*) AS n, count(*) FILTER (k % 2 = 1) AS n_open, count(*) FILTER (k % 3 <> 0) AS n_abstract, count(*) FILTER (k % 7 = 0) AS n_retracted, (SELECT string_agg('title ' || CAST(j AS VARCHAR), '|' ORDER BY j) FROM range(0, 10) q(j)) AS titles FROM range(0, 95) r(k)")
def search_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A search in counts, with its first ten titles."""
    return artifacts.preview(_found(spark)).withColumn("titles", F.array_join("titles", "|"))


@query("local_copies", "SELECT CAST(doc_id AS VARCHAR) AS source_id, CASE WHEN doc_id % 3 <> 0 THEN 'added' WHEN doc_id % 5 = 0 THEN 'conflict' ELSE 'identical' END AS outcome FROM documents WHERE doc_id % 2 = 0")
def local_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Local copies added to those that are there: new, the same file again, or another one under a stored id."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("doc_id").cast("string").alias("source_id"), F.sha2("text", 256).alias("sha256"))
    new = d.where("doc_id % 2 = 0").withColumn("sha256", F.when(F.col("doc_id") % 5 == 0, F.sha2(F.lit("another"), 256)).otherwise(F.col("sha256")))
    return search.add_local(d.where("doc_id % 3 = 0"), new).select("source_id", "outcome")


@query("carried_forward", "SELECT CAST(doc_id AS VARCHAR) AS source_id, 'full_text' AS route FROM documents WHERE doc_id % 2 = 0 UNION ALL SELECT CAST(doc_id AS VARCHAR), 'local_pdf' FROM documents WHERE doc_id % 2 <> 0 AND doc_id % 3 = 0")
def carried_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A new search keeps the local copies of an earlier one that it doesn't find itself."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("doc_id").cast("string").alias("source_id"))
    before = d.select("source_id", F.when(F.col("doc_id") % 3 == 0, "local_pdf").otherwise("abstract_only").alias("route"))
    return search.carry_forward(d.where("doc_id % 2 = 0").select("source_id", F.lit("full_text").alias("route")), before)


@query("run_manifest", "SELECT count(*) AS n_sources, count(*) FILTER (o_orderkey % 6 = 0) AS n_done, count(*) FILTER (o_orderkey % 6 = 1) AS n_empty, count(*) FILTER (o_orderkey % 6 = 2) AS n_incomplete, count(*) FILTER (o_orderkey % 6 = 3) AS n_error, count(*) FILTER (o_orderkey % 6 = 4) AS n_carried, sum(o_custkey % 9)::BIGINT AS n_records, sum(o_custkey % 3)::BIGINT AS n_written FROM orders")
def run_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run's sources by state, and its records."""
    states = F.array(*[F.lit(s) for s in ("done", "empty", "incomplete", "error", "carried", "other")])
    return reports.run_totals(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("source_id"), F.get(states, (F.col("o_orderkey") % 6).cast("int")).alias("state"), (F.col("o_custkey") % 9).alias("n_records"), (F.col("o_custkey") % 3).alias("n_written")))


_RUNGS = "WITH known AS (SELECT DISTINCT p_name AS c FROM part WHERE p_partkey % 4 = 0), brands AS (SELECT DISTINCT p_brand AS c FROM part WHERE p_size % 2 = 0), r AS (SELECT p_partkey, CASE WHEN p_name IN (SELECT c FROM known) THEN 0 WHEN p_brand IN (SELECT c FROM brands) THEN 1 END AS rung, p_name, p_brand FROM part)"


def _resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    known = p.where("p_partkey % 4 = 0").select(F.col("p_name").alias("candidate")).unionByName(p.where("p_size % 2 = 0").select(F.col("p_brand").alias("candidate"))).distinct()
    names = p.select(F.col("p_partkey").alias("name"), F.array("p_name", "p_brand").alias("candidates"))
    return artifacts.resolve_rungs(names, known.withColumn("taxon", F.concat(F.lit("t:"), "candidate")))


@query("taxon_rungs", f"{_RUNGS} SELECT p_partkey, rung::INT AS rung, CASE rung WHEN 0 THEN 't:' || p_name WHEN 1 THEN 't:' || p_brand END AS taxon, CASE WHEN rung IS NOT NULL THEN rung = 1 AND p_brand = 'Brand#1' END AS same_as_first FROM r")
def taxon_rungs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names resolved by the first of their candidates that an authority knows, and whether two of them are one organism."""
    return _resolved(spark, sf_dir).select(F.col("name").alias("p_partkey"), "rung", "taxon", artifacts.same_organism(F.col("taxon"), F.lit("t:Brand#1")).alias("same_as_first"))


@query("authority_fields", f"{_RUNGS} SELECT p_partkey, f AS field_name, CASE WHEN f = 'rung' THEN CAST(rung AS VARCHAR) WHEN rung = 0 THEN 't:' || p_name ELSE 't:' || p_brand END AS value, 'authority_resolved' AS grounding_mode, 1.0::DOUBLE AS c_grounded FROM r, (VALUES ('rung'), ('taxon')) v(f) WHERE rung IS NOT NULL")
def authority_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an authority adds to a record after scoring, as fields; unresolved names add none."""
    return artifacts.authority_fields(_resolved(spark, sf_dir).withColumnRenamed("name", "p_partkey"), ["p_partkey"], ["rung", "taxon"])


_SPEC = {
    "research_question": "What does it weigh?", "unit_of_analysis": "item", "ml_task": "regression", "fields": [{"name": "mass", "type": "float", "unit": "kg", "valid_range": [0, 10]}, {"name": "name", "type": "str", "locked": True}],
    "ledger": {"items": [{"item_id": "field:mass", "kind": "field", "status": "accepted"}, {"item_id": "field:name", "kind": "field", "status": "accepted"}, {"item_id": "q", "kind": "corpus_query", "status": "accepted"}, {"item_id": "open", "kind": "rule", "status": "proposed"}]},
    "source_scope": {"adapters": ["literature"], "queries": [{"item_id": "q", "query": "mass", "executable": True}]},
}
_SPEC_ROWS = [
    ("ratified", "field:mass,field:name,q"), ("open", "open"), ("query", "mass"), ("context", "What does it weigh?|Unit: item|- mass (float); in kg; within 0 to 10|- name (str)"), ("bar", "not calibrated: the default bar"), ("locked", "name"), ("same hash", "true"), ("other hash", "false"),
    ("preflight", "open is still open"), ("preflight of nothing", "ensemble_k must be a whole number of at least 1"), ("unratified", "field mass isn't ratified"), ("unknown task", "unknown task sorting"), ("edit", "ledger item q: an edit needs a note"), ("proposed", "field:mass=proposed,field:name=proposed,corpus_query:mass=proposed"),
    ("built", "mass,name"), ("themes", "size:2"), ("frozen", "v4:big,small"),
]


@query("specification_rules", expected("rule string, made string", _SPEC_ROWS))
def specification_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a specification says, refuses and turns into: ratification, run plan, preflight, intake, and themes."""

    def refused(change) -> str:
        d = json.loads(json.dumps(_SPEC))
        change(d)
        try:
            spec.Spec.load(d)
        except spec.SpecError as why:
            return "|".join(why.problems)
        return "nothing"

    own = spec.Spec.load(_SPEC)
    config = spec.plan(own, identity={"item": "name"})
    draft = spec.parse_proposal({"fields": _SPEC["fields"], "queries": [{"query": "mass"}]})
    ruled = {k: {**v, "status": "accepted"} for k, v in spec.default_rulings(draft).items()}
    built = spec.build_spec(draft, ruled, question="What?", unit="item")
    themes = spec.parse_themes({"themes": [{"name": "size", "claims": ["a", "b", "gone"]}, {"name": "none", "claims": ["gone"]}]}, {"a", "b"})
    frozen = spec.freeze_themes({"fields": [], "ledger": {"items": []}}, [{"theme": "small"}, {"theme": "big"}], "v3")
    made = [
        ",".join(sorted(own.ratified)), ",".join(i["item_id"] for i in own.open_items), spec.the_query(own), own.context().replace("\n", "|"), own.bar_provenance(), ",".join(config["locked_fields"]),
        str(spec.config_hash(config) == spec.config_hash({**config, "run_id": "x"})).lower(), str(spec.config_hash(config) == spec.config_hash({**config, "ensemble_k": 5})).lower(), "|".join(spec.preflight(config, own)), "|".join(spec.preflight({})),
        refused(lambda d: d["ledger"]["items"].pop(0)), refused(lambda d: d.update(ml_task="sorting")), refused(lambda d: d["ledger"]["items"][2].update(status="accepted_with_edit")),
        ",".join(f"{k}={v['status']}" for k, v in spec.default_rulings(draft).items()), ",".join(f["name"] for f in built.fields), ",".join(f"{t['theme']}:{len(t['claims'])}" for t in themes), f"{frozen['version']}:{','.join(frozen['fields'][0]['enum'])}",
    ]
    assert replace(own, task=None).problems() == []
    return given(spark, "rule string, made string", [(r, m) for (r, _), m in zip(_SPEC_ROWS, made)])


_ITEMS = "WITH li AS (SELECT CAST(l_orderkey AS VARCHAR) AS source_id, CAST(l_partkey AS VARCHAR) AS code, min(CAST(CAST(l_quantity AS INT) AS VARCHAR)) AS qty, min(l_linenumber) AS line FROM lineitem GROUP BY 1, 2)"


@query(
    "merged_fields",
    f"""{_ITEMS} SELECT source_id, 'r' || code AS record_id, f AS field_name, CASE WHEN f = 'code' THEN code ELSE qty END AS value, 'item ' || code || ' x ' || qty || ';' AS quote, 0 AS from_pass, CASE WHEN f = 'qty' AND line % 3 = 0 THEN 2 ELSE 3 END AS n_agreeing, 0 AS n_missing, false AS ambiguous
FROM li, (VALUES ('code'), ('qty')) v(f)""",
)
def merged_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of three merged passes with the quote of the pass that gave the value."""
    records, fields, _, parts = passes_of_orders(spark, sf_dir)
    _, merged = replay.merged_records(records, fields, replay.Identity.of("code"), 3, parts)
    return merged.select("source_id", "record_id", "field_name", "value", "quote", "from_pass", "n_agreeing", "n_missing", "ambiguous")


@query(
    "applied_verdicts",
    """SELECT o_orderkey AS record_id, CASE WHEN o_orderkey % 3 = 0 THEN 'partial' WHEN o_orderstatus = 'F' THEN 'unparseable' ELSE 'not_run' END AS judge_verdict, CASE WHEN o_orderkey % 3 = 0 THEN repeat('n', 400) END AS judge_note FROM orders""",
)
def applied_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on the records that were asked about: answered, asked without an answer, or never asked."""
    o = table(spark, sf_dir, "orders")
    picked = o.select(F.col("o_orderkey").alias("record_id"), (F.col("o_orderstatus") == "F").alias("to_judge"))
    verdicts = o.where("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("record_id"), F.lit("partial").alias("verdict"), F.repeat(F.lit("n"), 500).alias("note"))
    return selection.apply_verdicts(picked, verdicts).drop("to_judge")


@query(
    "record_evidence",
    """WITH q AS (SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN NULL ELSE text END AS text, substr(text, 1, 20) AS a, substr(text, 3, 20) AS b, n_chars FROM documents),
s AS (SELECT doc_id, CASE WHEN text IS NULL THEN 2 WHEN length(a) > 0 THEN 0 WHEN 0 >= length(text) THEN 4 ELSE 3 END AS x, CASE WHEN text IS NULL THEN 2 WHEN length(b) > 0 AND substr(text, 1, length(b)) = b THEN 0 WHEN length(b) > 0 AND strpos(text, b) > 0 THEN 1 WHEN 0 >= length(text) THEN 4 ELSE 3 END AS y FROM q)
SELECT doc_id AS record_id, ['exact', 'moved', 'no_store', 'absent', 'past_end'][greatest(x, y) + 1] AS evidence FROM s""",
)
def record_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates with the text of their source: a record's evidence is as good as that of its worst quote."""
    d = table(spark, sf_dir, "documents")
    candidates = d.select(F.col("doc_id").alias("record_id"), F.col("doc_id").alias("source_id"), F.array(F.substring("text", 1, 20), F.substring("text", 3, 20)).alias("quotes"))
    held = d.where("doc_id % 9 <> 0").select(F.col("doc_id").alias("source_id"), "text")
    states = F.array(*[spans.anchor_state(F.get("quotes", F.lit(k)), F.lit(0), F.col("text"))["state"] for k in (0, 1)])
    return reports.record_view(candidates, held, spans.worst_state(states)).select("record_id", "evidence")


@query("page_of_offset", "SELECT doc_id AS source_id, (n_chars // 2)::INT AS \"offset\", CASE WHEN n_chars // 2 < length(text) AND (n_chars // 2) % 500 < 490 THEN ((n_chars // 2) // 500 + 1)::INT END AS page FROM documents")
def page_of_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page in the middle of each document, on pages of 490 signs with gaps of ten between them."""
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("source_id"), F.expr("cast(n_chars div 2 as int)").alias("offset"), F.length("text").alias("n"))
    at = F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.expr("cast((n - 1) div 500 as int)"))))
    rows = d.select("source_id", "n", at.alias("k")).select("source_id", (F.col("k") + 1).cast("int").alias("page_no"), (F.col("k") * 500).alias("start"), F.least(F.col("k") * 500 + 490, F.col("n")).alias("end"))
    return spans.page_of(d.select("source_id", "offset"), rows)


@query("missing_stores", "SELECT CAST(doc_id AS VARCHAR) AS source_id FROM documents WHERE doc_id % 4 = 1")
def missing_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers of a run that have no store."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("doc_id").cast("string").alias("source_id"))
    return spec.missing_stores(d.select("source_id"), d.where("doc_id % 4 <> 1").select("source_id"))


@query("dedup_report", f"SELECT verdict, count(*) AS n, count(*) FILTER (registered) AS n_registered FROM ({oracle_of('dedup_identifiers')}) GROUP BY verdict")
def dedup_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers of each verdict of the registry of identifiers."""
    return corpus.dedup_report(corpus.dedupe_identifiers(_papers(spark, sf_dir)))


@query(
    "set_operations",
    """WITH a AS (SELECT l_suppkey AS k, l_linenumber AS n FROM lineitem), b AS (SELECT o_custkey AS k, 1 + o_orderkey % 7 AS n FROM orders)
SELECT how, k, n::INT AS n, count(*) AS times FROM (
  SELECT 'union_all' AS how, * FROM (SELECT * FROM a UNION ALL SELECT * FROM b) UNION ALL SELECT 'intersect_all', * FROM (SELECT * FROM a INTERSECT ALL SELECT * FROM b) UNION ALL SELECT 'except_all', * FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)
  UNION ALL SELECT 'union', * FROM (SELECT * FROM a UNION SELECT * FROM b) UNION ALL SELECT 'intersect', * FROM (SELECT * FROM a INTERSECT SELECT * FROM b) UNION ALL SELECT 'except', * FROM (SELECT * FROM a EXCEPT SELECT * FROM b))
GROUP BY how, k, n""",
)
def set_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables combined as sets and as bags, their columns matched by name."""
    a = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("k"), F.col("l_linenumber").cast("int").alias("n"))
    b = table(spark, sf_dir, "orders").select((1 + F.col("o_orderkey") % 7).cast("int").alias("n"), F.col("o_custkey").alias("k"))
    out = None
    for how in sets.KINDS:
        got = sets.combine(a, b, how).select(F.lit(how).alias("how"), "k", "n")
        out = got if out is None else out.unionByName(got)
    return out.groupBy("how", "k", "n").agg(F.count("*").alias("times"))


_Q = """WITH o AS (SELECT CAST(o_custkey % 20 AS VARCHAR) AS paper, o_orderkey AS k FROM orders)"""


@query(
    "run_questions",
    f"""{_Q}, q AS (
  SELECT paper, CASE WHEN k % 4 = 1 THEN 'scope_disagreement' WHEN k % 3 = 0 THEN 'weak_identity' ELSE 'ambiguous_anchor' END AS kind FROM o WHERE k % 4 = 1 OR k % 3 = 0 OR (k % 3 = 1 AND k % 5 = 0)
  UNION ALL SELECT paper, 'no_consensus_value' FROM o WHERE k % 6 = 0 AND k % 7 <> 0
  UNION ALL SELECT paper, 'no_verdict' FROM o WHERE k % 8 = 0 UNION ALL SELECT paper, 'judge_veto' FROM o WHERE k % 8 = 1 UNION ALL SELECT paper, 'audit_disagreement' FROM o WHERE k % 8 = 2 UNION ALL SELECT paper, 'colliding_record_id' FROM o WHERE k % 8 = 3
  UNION ALL SELECT paper, 'verification_unusable' FROM o WHERE k % 9 = 4 GROUP BY paper
  UNION ALL SELECT paper, 'pass_failed' FROM o WHERE k % 10 = 5 UNION ALL SELECT paper, 'unanchorable_quote' FROM o WHERE k % 10 = 6
  UNION ALL SELECT paper, CASE WHEN CAST(paper AS INT) % 5 = 0 THEN 'paper_failed' ELSE 'verification_skipped' END FROM (SELECT DISTINCT paper FROM o) WHERE CAST(paper AS INT) % 5 < 2)
SELECT paper, kind, count(*) AS n FROM q GROUP BY paper, kind""",
)
def run_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions that a run leaves to a person, counted by paper and kind."""
    o = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 20).cast("string").alias("source_id"), F.col("o_orderkey").alias("k"))
    ident = F.col("k").cast("string")
    alignment = o.select("source_id", ident.alias("identity"), F.when(F.col("k") % 4 == 1, 1).otherwise(3).alias("found_by_passes"), F.when(F.col("k") % 3 == 0, "ordinal").when(F.col("k") % 3 == 1, "anchored").otherwise("primary").alias("identity_tier"), (F.col("k") % 5 != 0).alias("anchor_unique"))
    values = o.select("source_id", ident.alias("record_id"), F.when(F.col("k") % 7 == 0, "note").otherwise("mass").alias("field_name"), (F.col("k") % 6 == 0).alias("ambiguous"))
    kind = F.when(F.col("k") % 8 == 0, "no_verdict").when(F.col("k") % 8 == 1, "judge_veto").when(F.col("k") % 8 == 2, "audit_disagreement").when(F.col("k") % 8 == 3, "colliding_record_id")
    judged = o.select("source_id", ident.alias("record_id"), kind.alias("kind")).where("kind is not null")
    blocked = o.where("k % 9 = 4").groupBy("source_id").agg(F.count("*").alias("n"))
    failures = o.where("k % 10 = 5").select("source_id", ident.alias("pass"), F.lit("timeout").alias("why"))
    dropped = o.where("k % 10 = 6 or k % 10 = 7").select("source_id", ident.alias("record_id"), F.when(F.col("k") % 10 == 6, "absent").otherwise("no quote").alias("why"))
    runs = o.select("source_id").distinct().withColumn("state", F.when(F.col("source_id").cast("int") % 5 == 0, "error").when(F.col("source_id").cast("int") % 5 == 1, "incomplete").otherwise("done"))
    out = selection.run_questions(alignment, values, judged, blocked, failures, dropped, runs, lane=("note",))
    return out.groupBy(F.col("source_id").alias("paper"), "kind").agg(F.count("*").alias("n"))


@query("call_timeouts", "SELECT doc_id, least(floor(420 + strlen(text) / 1024.0::DOUBLE * 12)::INT, 1800)::INT AS seconds FROM documents")
def call_timeouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seconds that a call on a source may take: a base and a rate a kilobyte, up to a ceiling."""
    return table(spark, sf_dir, "documents").select("doc_id", accounting.call_timeout(F.octet_length("text")).alias("seconds"))


@query("iso_times", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN microsecond(ts) % 1000000 = 0 THEN '' ELSE '.' || strftime(ts, '%f') END || '+00:00' AS at FROM events")
def iso_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times as they are stored: ISO 8601 in UTC, without a fraction where there is none."""
    return table(spark, sf_dir, "events").select("event_id", accounting.iso_utc(F.col("ts")).alias("at"))
