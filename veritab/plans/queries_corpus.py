"""Queries of corpora, spans, output tables, accounts, merging and exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veritab.functions import text as tx
from veritab.operators import accounting, corpus, mapping, merge, reports, review, selection, spans
from veritab.plans import inputs as src
from veritab.plans.inputs import table
from veritab.plans.registry import query
from veritab.sources import search

_UPSERT = "SELECT o_orderkey AS seq, CAST(o_custkey AS STRING) || ':' || o_orderpriority AS record_id, o_orderstatus AS payload FROM orders"


@query(
    "collision_upsert",
    f"""WITH n AS (SELECT *, first_value(payload) OVER w AS standing, row_number() OVER w AS k FROM ({_UPSERT}) WINDOW w AS (PARTITION BY record_id ORDER BY seq))
SELECT seq, record_id, payload, CASE WHEN k = 1 THEN 'written' WHEN payload = standing THEN 'identical' ELSE 'collision' END AS outcome FROM n""",
)
def collision_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted rows are never changed: the same payload again is fine, another one a collision."""
    new = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("seq"), F.concat_ws(":", F.col("o_custkey").cast("string"), "o_orderpriority").alias("record_id"), F.col("o_orderstatus").alias("payload"))
    return review.resolve_upserts(new)


@query(
    "candidate_last_writer",
    f"SELECT record_id, arg_max(payload, seq) AS payload, max(seq) AS seq FROM ({_UPSERT}) GROUP BY record_id",
)
def candidate_last_writer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates are replaced by their latest row."""
    new = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("seq"), F.concat_ws(":", F.col("o_custkey").cast("string"), "o_orderpriority").alias("record_id"), F.col("o_orderstatus").alias("payload"))
    return review.last_writer(new, ["record_id"], "seq")


@query("accepted_view", "SELECT o_orderkey AS record_id, o_orderstatus AS route, CAST(CAST(o_orderdate AS DATE) AS STRING) AS written_at FROM orders WHERE o_orderstatus = 'F' ORDER BY written_at DESC, record_id LIMIT 100")
def accepted_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest hundred accepted rows of a route."""
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("record_id"), F.col("o_orderstatus").alias("route"), F.col("o_orderdate").cast("date").cast("string").alias("written_at"))
    return review.accepted_view(rows, route="F", limit=100)


_CANDIDATES = f"SELECT doc_id AS record_id, source AS source_id, {src.SCORE} AS composite, CASE WHEN (n_chars + doc_id) % 4 = 0 THEN 'allowed' ELSE 'denied' END AS decision FROM documents"


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("record_id"), F.col("source").alias("source_id"), F.expr(src.SCORE).alias("composite"), F.expr("CASE WHEN (n_chars + doc_id) % 4 = 0 THEN 'allowed' ELSE 'denied' END").alias("decision"))


def _rulings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("source_id"))
    return src.rulings(spark, sf_dir).join(docs, "doc_id").select(F.col("doc_id").alias("record_id"), "source_id", "verdict", F.concat(F.lit("r"), (F.col("doc_id") % 3).cast("string"), F.when(F.col("doc_id") % 3 == 0, " [browser]").when(F.col("doc_id") % 3 == 1, " [chat]").otherwise("")).alias("adjudicator"))


_RULED = f"SELECT r.doc_id AS record_id, d.source AS source_id, r.verdict, CASE r.doc_id % 3 WHEN 0 THEN 'browser' WHEN 1 THEN 'chat' ELSE 'unknown' END AS surface FROM ({src.RULINGS_SQL}) r JOIN documents d ON d.doc_id = r.doc_id"


@query("adjudications_join", f"SELECT r.record_id, r.source_id, r.verdict, r.surface, c.composite, c.decision FROM ({_RULED}) r LEFT JOIN ({_CANDIDATES}) c ON c.record_id = r.record_id AND c.source_id = r.source_id")
def adjudications_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rulings with the candidates they are about and the surface they came from."""
    return review.adjudications(_rulings(spark, sf_dir), _candidates(spark, sf_dir)).drop("adjudicator")


@query("surface_verdicts", f"SELECT surface, count(*) FILTER (verdict = 'right') AS \"right\", count(*) FILTER (verdict = 'wrong') AS wrong, count(*) FILTER (verdict = 'cant_tell') AS cant_tell FROM ({_RULED}) GROUP BY surface")
def surface_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rulings by the surface they came from."""
    rows = review.adjudications(_rulings(spark, sf_dir), _candidates(spark, sf_dir))
    return rows.groupBy("surface").agg(*[F.count_if(F.col("verdict") == v).alias(v) for v in ("right", "wrong", "cant_tell")])


@query(
    "unadjudicated_queue",
    f"SELECT record_id, source_id, composite, decision FROM ({_CANDIDATES}) c WHERE decision = 'denied' AND NOT EXISTS (SELECT 1 FROM ({_RULED}) r WHERE r.record_id = c.record_id AND r.source_id = c.source_id) ORDER BY composite DESC, source_id, record_id LIMIT 50",
)
def unadjudicated_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Denied candidates that nobody has ruled on, best first: the head of the queue."""
    return review.review_queue(_candidates(spark, sf_dir), _rulings(spark, sf_dir))


@query(
    "queue_by_root_cause",
    f"""WITH c AS (SELECT *, CASE WHEN record_id % 7 = 0 THEN 0.0 ELSE 1.0 END AS g, record_id % 5 = 0 AS contradicted FROM ({_CANDIDATES}) WHERE decision = 'denied'),
d AS (SELECT record_id, source_id, composite, CASE WHEN g = 0 AND (composite < 0.95 OR record_id % 3 = 0) THEN 0 WHEN contradicted THEN 1 WHEN composite < 0.95 THEN 5 WHEN record_id % 3 = 0 THEN 6 ELSE 7 END AS cause_rank, contradicted::INT AS open_questions FROM c)
SELECT * FROM d ORDER BY cause_rank, open_questions, source_id, record_id LIMIT 50""",
)
def queue_by_root_cause(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The queue by what one ruling can teach; sorted before it is cut."""
    why = lambda cond, code, about: F.when(cond, F.struct(F.lit(code).alias("code"), F.lit(about).alias("about")))
    reasons = F.filter(F.array(why(F.col("composite") < 0.95, "composite_below_bar", None), why(F.col("record_id") % 5 == 0, "contradicted", "f"), why(F.col("record_id") % 3 == 0, "judge", "not_run")), lambda r: r.isNotNull())
    field = F.from_json(F.lit("{}"), "field_name string, value string, value_kind string, route string, has_provenance boolean, source_status string, contradiction_search string, n_contradictions int, c_grounded double")
    fields = F.array(field.withField("field_name", F.lit("f")).withField("c_grounded", F.when(F.col("record_id") % 7 == 0, 0.0).otherwise(1.0)))
    rows = _candidates(spark, sf_dir).withColumn("reasons", reasons).withColumn("fields", fields)
    return review.review_queue(rows, order="root_cause").select("record_id", "source_id", "composite", "cause_rank", "open_questions")


@query(
    "check_queue",
    f"""SELECT c.record_id, c.source_id, c.composite, c.decision, CASE WHEN record_id % 2 = 0 THEN 'supported' ELSE 'partial' END AS judge_verdict FROM ({_CANDIDATES}) c
WHERE decision <> 'allowed' AND NOT EXISTS (SELECT 1 FROM ({_RULED}) r WHERE r.record_id = c.record_id AND r.source_id = c.source_id)""",
)
def check_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held candidates for the checking page, those that the judge supports first."""
    c = _candidates(spark, sf_dir).withColumn("judge_verdict", F.when(F.col("record_id") % 2 == 0, "supported").otherwise("partial"))
    return review.check_queue(c, c.where("decision = 'allowed'"), _rulings(spark, sf_dir)).drop("ruling")


@query(
    "entity_index",
    """WITH r AS (SELECT p_partkey, CAST(p_partkey % 20 AS STRING) AS source_id, CASE WHEN p_partkey % 3 = 0 THEN lower(p_brand) || '/' || lower(p_type) END AS acc, lower(p_name) AS name, lower(p_type) AS type, CAST(p_size AS STRING) AS size FROM part),
k AS (SELECT *, coalesce(acc, name || ' | ' || type) AS key, CASE WHEN acc IS NOT NULL THEN 'accession' ELSE 'fallback' END AS basis FROM r)
SELECT key AS canonical_key, basis, count(*) AS n_records, count(DISTINCT source_id)::INT AS n_sources, string_agg(CAST(p_partkey AS STRING), ',' ORDER BY p_partkey) AS members,
  (count(DISTINCT size) > 1)::INT + (count(DISTINCT type) > 1)::INT + (count(DISTINCT name) > 1)::INT AS n_conflicts FROM k GROUP BY key, basis""",
)
def entity_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities above per-source records, with what their sources disagree on."""
    out = corpus.entity_index(_entities(spark, sf_dir), ["size", "type", "name"])
    return out.select("canonical_key", "basis", "n_records", "n_sources", F.array_join(F.transform("member_record_ids", lambda x: x.cast("string")), ",").alias("members"), F.size("conflicts").alias("n_conflicts"))


def _entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("record_id"), (F.col("p_partkey") % 20).cast("string").alias("source_id"), F.when(F.col("p_partkey") % 3 == 0, F.concat_ws("/", F.lower("p_brand"), F.lower("p_type"))).alias("acc"),
        F.lower("p_name").alias("name"), F.lower("p_type").alias("type"), F.col("p_size").cast("string").alias("size"),
    )
    k = corpus.canonical_key([F.col("acc")], [F.col("name"), F.col("type")])
    return p.withColumn("_k", k).select("*", "_k.key", "_k.basis").drop("_k")


@query(
    "entity_counts",
    """WITH k AS (SELECT CASE WHEN p_partkey % 3 = 0 THEN lower(p_brand) || '/' || lower(p_type) ELSE lower(p_name) || ' | ' || lower(p_type) END AS key, CASE WHEN p_partkey % 3 = 0 THEN 'accession' ELSE 'fallback' END AS basis FROM part),
e AS (SELECT key, basis, count(*) AS n FROM k GROUP BY key, basis) SELECT basis, count(*) AS n_entities, sum(n)::BIGINT AS n_records, sum(n - 1)::BIGINT AS n_linked FROM e GROUP BY basis""",
)
def entity_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities and linked records by what they were matched on."""
    return corpus.entity_counts(corpus.entity_index(_entities(spark, sf_dir), ["size"]))


_TERMS, _NOT = ("with", "stupid"), ("trash",)
#: The engine's boundary is between letters of any script; DuckDB's \\b knows ASCII only, so there it is written out.
_RX = {t: rf"(?i)(?:^|[^\p{{L}}\p{{M}}\p{{N}}_]){t}(?:e?s)?(?:$|[^\p{{L}}\p{{M}}\p{{N}}_])" for t in (*_TERMS, *_NOT)}


@query(
    "screen_corpus",
    f"""WITH s AS (SELECT doc_id AS source_id, substr(text, 1, 3000) AS head, length(text) AS n FROM documents)
SELECT source_id, CASE WHEN n = 0 OR n IS NULL THEN 'uncertain' WHEN regexp_matches(head, '{_RX['trash']}') THEN 'excluded' WHEN regexp_matches(head, '{_RX['with']}') OR regexp_matches(head, '{_RX['stupid']}') THEN 'present' ELSE 'uncertain' END AS verdict,
  CASE WHEN n = 0 OR n IS NULL THEN 'empty' ELSE 'head:' || CAST(least(3000, n) AS STRING) END AS scope FROM s""",
)
def screen_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the head of each source names a term; a miss there is uncertain, not absent. The head is the operator's own."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("source_id"), "text")
    return corpus.screen_corpus(docs, require_any=_TERMS, exclude_any=_NOT).select("source_id", "verdict", "scope")


@query(
    "screen_full_text_counts",
    f"""SELECT CASE WHEN text = '' OR text IS NULL THEN 'uncertain' WHEN regexp_matches(text, '{_RX['trash']}') THEN 'excluded' WHEN regexp_matches(text, '{_RX['with']}') OR regexp_matches(text, '{_RX['stupid']}') THEN 'present' ELSE 'absent' END AS verdict, count(*) AS n
FROM documents GROUP BY 1""",
)
def screen_full_text_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of verdicts where the whole text was searched: a miss is an absence."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("source_id"), "text")
    return corpus.screen_counts(corpus.screen_corpus(docs, require_any=_TERMS, exclude_any=_NOT, full_text=True))


def _papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nothing = F.lit(None).cast("string")
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("ord"), F.concat(F.lit("HTTPS://doi.org/10.1/"), F.md5(F.col("text").cast("binary"))).alias("doi"), F.when(F.col("doc_id") % 10 < 3, F.expr("doc_id div 50").cast("string")).alias("pmid"),
        *[nothing.alias(c) for c in corpus.IDENTIFIERS], F.col("doc_id").cast("string").alias("id"), F.substring("text", 1, 60).alias("title"), F.array(F.col("source")).alias("authors"), F.lit(2020).alias("year"),
    )


@query(
    "dedup_identifiers",
    """WITH RECURSIVE p AS (SELECT doc_id AS ord, '10.1/' || md5(text) AS doi, CASE WHEN doc_id % 10 < 3 THEN CAST(doc_id // 50 AS STRING) END AS pmid FROM documents),
o AS (SELECT *, row_number() OVER (ORDER BY ord) AS k FROM p),
step(k, ord, verdict, dois, pmids) AS (
  SELECT 0::BIGINT, NULL::BIGINT, NULL::VARCHAR, []::VARCHAR[], []::VARCHAR[]
  UNION ALL
  SELECT o.k, o.ord, CASE WHEN list_contains(s.dois, o.doi) THEN 'doi' WHEN o.pmid IS NOT NULL AND list_contains(s.pmids, o.pmid) THEN 'pmid' ELSE 'new' END,
    CASE WHEN list_contains(s.dois, o.doi) OR coalesce(list_contains(s.pmids, o.pmid), false) THEN s.dois ELSE list_append(s.dois, o.doi) END,
    CASE WHEN list_contains(s.dois, o.doi) OR coalesce(list_contains(s.pmids, o.pmid), false) OR o.pmid IS NULL THEN s.pmids ELSE list_append(s.pmids, o.pmid) END
  FROM step s JOIN o ON o.k = s.k + 1)
SELECT ord, verdict, verdict = 'new' AS registered FROM step WHERE k > 0""",
)
def dedup_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duplicate papers by identifier, as if registered one after another."""
    return corpus.dedupe_identifiers(_papers(spark, sf_dir)).select("ord", "verdict", "registered")


@query("dedup_fuzzy")
def dedup_fuzzy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole registry with titles compared by a sequence matcher, which SQL lacks: the first line is the title."""
    papers = _papers(spark, sf_dir).drop("title")
    titles = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("ord"), F.substring_index("text", "\n", 1).alias("title"))
    return corpus.dedupe(papers.join(titles, "ord"))


_ROUTED = "SELECT doc_id AS ord, CAST(doc_id AS STRING) AS source_id, CASE WHEN doc_id % 6 < 4 THEN '10.1/' || CAST(doc_id // 3 AS STRING) END AS doi, CASE doc_id % 5 WHEN 0 THEN 'full_text' WHEN 1 THEN 'local_pdf' WHEN 2 THEN 'abstract_only' WHEN 3 THEN 'retracted' ELSE 'abstract_only' END AS route FROM documents"


@query(
    "readable_sources",
    f"""SELECT ord, source_id, doi, route FROM (SELECT *, row_number() OVER (PARTITION BY coalesce(doi, 'id:' || source_id) ORDER BY CASE route WHEN 'full_text' THEN 0 WHEN 'local_pdf' THEN 1 ELSE 2 END, ord) AS k
FROM ({_ROUTED}) WHERE route <> 'retracted') WHERE k = 1""",
)
def readable_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One source a paper, the fullest text of it."""
    docs = table(spark, sf_dir, "documents")
    rows = docs.selectExpr("doc_id AS ord", "CAST(doc_id AS STRING) AS source_id", "CASE WHEN doc_id % 6 < 4 THEN '10.1/' || CAST(doc_id div 3 AS STRING) END AS doi", "CASE doc_id % 5 WHEN 0 THEN 'full_text' WHEN 1 THEN 'local_pdf' WHEN 2 THEN 'abstract_only' WHEN 3 THEN 'retracted' ELSE 'abstract_only' END AS route")
    return corpus.readable_sources(rows)


_FLAGS = "SELECT o_orderstatus = 'P' AND o_orderkey % 3 = 0 AS retracted, o_orderkey % 5 = 0 AS stored, o_orderpriority IN ('1-URGENT', '2-HIGH') AS oa, o_orderkey % 2 = 0 AS abstract FROM orders"


@query("fetch_outcomes", f"SELECT CASE WHEN retracted THEN 'retracted' WHEN stored OR oa THEN 'full_text' WHEN abstract THEN 'abstract_only' ELSE 'unreachable' END AS outcome, count(*) AS n FROM ({_FLAGS}) GROUP BY 1")
def fetch_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of search hits."""
    f = table(spark, sf_dir, "orders").selectExpr("o_orderstatus = 'P' AND o_orderkey % 3 = 0 AS retracted", "o_orderkey % 5 = 0 AS stored", "o_orderpriority IN ('1-URGENT', '2-HIGH') AS oa", "o_orderkey % 2 = 0 AS abstract")
    return f.groupBy(corpus.fetch_outcome(F.col("retracted"), F.col("stored"), F.col("oa"), F.col("abstract")).alias("outcome")).agg(F.count("*").alias("n"))


@query("prisma_flow", f"SELECT count(*) AS searched, count(*) FILTER (retracted) AS is_retracted, count(*) FILTER (oa) AS is_open, CAST(NULL AS BIGINT) AS is_screened FROM ({_FLAGS})")
def prisma_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of a selection flow; a step that was never counted has no number."""
    f = table(spark, sf_dir, "orders").selectExpr("o_orderstatus = 'P' AND o_orderkey % 3 = 0 AS is_retracted", "o_orderpriority IN ('1-URGENT', '2-HIGH') AS is_open", "CAST(NULL AS BOOLEAN) AS is_screened")
    return corpus.flow_counts(f)


@query("span_locate", "SELECT d.doc_id AS source_id, b.item_id AS quote_id, (strpos(d.text, b.text) - 1)::INT AS start FROM documents d, benchmark b WHERE strpos(d.text, b.text) > 0")
def span_locate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where documents quote the items of a stated set: by the longest inner word, then the text itself."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("source_id"), "text")
    return spans.quotes_in_texts(docs, table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("quote_id"), F.col("text").alias("quote")))


_BLOCKS = """SELECT doc_id AS source_id, i - 1 AS ord, CASE WHEN i = 1 THEN 'head' ELSE 'line' || CAST(i AS STRING) END AS title,
  coalesce(sum(length(l) + 1) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start, length(l) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)"""


def _sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of documents as sections."""
    lines = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("source_id"), F.posexplode(F.split("text", "\n")).alias("ord", "line")).select("source_id", "ord", F.length("line").alias("n"))
    before = Window.partitionBy("source_id").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.col("n") + 1).over(before), F.lit(0))
    title = F.when(F.col("ord") == 0, "head").otherwise(F.concat(F.lit("line"), (F.col("ord") + 1).cast("string")))
    return lines.select("source_id", "ord", title.alias("title"), start.alias("start"), (start + F.col("n")).alias("end"), F.lit(1).alias("depth"))


@query("section_of_offset", f"WITH s AS ({_BLOCKS}) SELECT o.source_id, o.offset_ AS \"offset\", s.title AS section FROM (SELECT doc_id AS source_id, n_chars // 2 AS offset_ FROM documents) o LEFT JOIN s ON s.source_id = o.source_id AND s.start <= o.offset_ AND o.offset_ < s.start + s.n")
def section_of_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The section in the middle of each document."""
    at = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("source_id"), F.expr("n_chars div 2").alias("offset"))
    return spans.innermost_section(at, _sections(spark, sf_dir))


@query(
    "anchor_state",
    """WITH q AS (SELECT doc_id, text, substr(text, 11, 25) AS quote, CASE doc_id % 4 WHEN 0 THEN 10 WHEN 1 THEN 13 WHEN 2 THEN 10 ELSE n_chars + 5 END AS off_, doc_id % 4 AS m FROM documents),
x AS (SELECT doc_id, CASE WHEN m = 2 THEN quote || '#~#' ELSE quote END AS quote, CASE WHEN doc_id % 9 = 0 THEN NULL ELSE text END AS text, off_ FROM q)
SELECT doc_id AS source_id, CASE WHEN text IS NULL THEN 'no_store' WHEN length(quote) > 0 AND substr(text, off_ + 1, length(quote)) = quote THEN 'exact' WHEN length(quote) > 0 AND strpos(text, quote) > 0 THEN 'moved' WHEN off_ >= length(text) THEN 'past_end' ELSE 'absent' END AS state FROM x""",
)
def anchor_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether stored offsets still hold their quotes."""
    d = table(spark, sf_dir, "documents")
    quote = F.concat(F.substring("text", 11, 25), F.when(F.col("doc_id") % 4 == 2, "#~#").otherwise(""))
    off = F.when(F.col("doc_id") % 4 == 1, 13).when(F.col("doc_id") % 4 == 3, F.col("n_chars") + 5).otherwise(10).cast("int")
    return d.select(F.col("doc_id").alias("source_id"), spans.anchor_state(quote, off, F.when(F.col("doc_id") % 9 != 0, F.col("text")))["state"].alias("state"))


@query("quote_slices", "SELECT doc_id, substr(text, (n_chars // 3)::INT + 1, 40) AS quote FROM documents")
def quote_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code points of a text by offsets from 0."""
    at = F.expr("n_chars div 3").cast("int")
    return table(spark, sf_dir, "documents").select("doc_id", tx.quote_at(F.col("text"), at, at + 40).alias("quote"))


_PASS_RECORDS = """SELECT l_orderkey AS source_id, l_suppkey % 3 AS pass_ix, row_number() OVER (PARTITION BY l_orderkey, l_suppkey % 3 ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS rec_ix, 'item' AS entity_type,
  CASE WHEN l_partkey % 4 <> 0 THEN CAST(l_partkey AS STRING) END AS code, CASE WHEN l_partkey % 8 <> 0 THEN l_returnflag END AS flag, CASE WHEN l_linenumber % 2 = 0 THEN l_linestatus END AS status, 'r' || CAST(l_partkey % 50 AS STRING) AS record_id FROM lineitem"""
_IDENT = f"""WITH p AS ({_PASS_RECORDS}), n AS (SELECT *, CASE WHEN code IS NOT NULL THEN code WHEN flag IS NOT NULL AND status IS NOT NULL THEN flag || '|' || status END AS named,
  CASE WHEN code IS NOT NULL THEN 'primary' WHEN flag IS NOT NULL AND status IS NOT NULL THEN 'fallback1' END AS tier FROM p),
i AS (SELECT *, coalesce(named, coalesce(flag, '') || '#ord' || CAST(row_number() OVER (PARTITION BY source_id, pass_ix, entity_type, flag, named IS NULL ORDER BY rec_ix) - 1 AS STRING)) AS identity, coalesce(tier, CASE WHEN flag IS NOT NULL THEN 'ordinal' ELSE 'ordinal_unscoped' END) AS identity_tier FROM n)"""


def _identified(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "lineitem").createOrReplaceTempView("_pass_lines")
    rows = spark.sql(_PASS_RECORDS.replace("FROM lineitem", "FROM _pass_lines"))
    ident = merge.Identity.of({"chain": ["code", ["flag", "status"]], "ordinal_within": "flag"})
    return merge.with_identity(rows, ident, {c: F.col(c) for c in ("code", "flag", "status")})


@query("merge_identity_tiers", _IDENT + " SELECT identity_tier, count(*) AS n FROM (SELECT source_id, identity, arg_max(tier2, pass_ix) AS identity_tier FROM (SELECT source_id, identity, pass_ix, arg_max(identity_tier, rec_ix) AS tier2 FROM i GROUP BY ALL) GROUP BY source_id, identity) GROUP BY identity_tier")
def merge_identity_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What records of several passes were aligned on."""
    rows = _identified(spark, sf_dir).withColumns({"review_only": F.lit(False), "review_reason": F.lit(None).cast("string")})
    return merge.tier_histogram(merge.align(rows))


@query(
    "merged_ids",
    _IDENT
    + """, l AS (SELECT source_id, identity, pass_ix, arg_max(record_id, rec_ix) AS record_id FROM i GROUP BY ALL),
a AS (SELECT source_id, identity, count(*) AS found_by_passes, arg_min(record_id, pass_ix) AS record_id FROM l GROUP BY source_id, identity)
SELECT source_id, identity, found_by_passes, CASE WHEN count(*) OVER (PARTITION BY source_id, record_id) > 1 THEN record_id || '#' || substr(sha1(identity), 1, 8) ELSE record_id END AS merged_id FROM a""",
)
def merged_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aligned records with ids of their own."""
    rows = _identified(spark, sf_dir).withColumns({"review_only": F.lit(False), "review_reason": F.lit(None).cast("string")})
    return merge.align(rows).select("source_id", "identity", "found_by_passes", "merged_id")


_USAGE = "SELECT CAST(user_id AS STRING) AS unit, event_type AS stage, CAST(floor(value) AS BIGINT) AS input, CAST(event_id % 50 AS BIGINT) AS output, CAST(event_id % 7 AS BIGINT) AS cache_read, CAST(event_id % 3 AS BIGINT) AS cache_write, event_id, ts FROM events"


def _usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr("CAST(user_id AS STRING) AS unit", "event_type AS stage", "CAST(floor(value) AS BIGINT) AS input", "CAST(event_id % 50 AS BIGINT) AS output", "CAST(event_id % 7 AS BIGINT) AS cache_read", "CAST(event_id % 3 AS BIGINT) AS cache_write", "event_id", "ts")


@query(
    "usage_grouping_sets",
    f"""SELECT unit, stage, sum(input)::BIGINT AS input, sum(output)::BIGINT AS output, sum(cache_read)::BIGINT AS cache_read, sum(cache_write)::BIGINT AS cache_write, grouping(unit, stage)::BIGINT AS grouping_level,
  sum(input + cache_write + output)::BIGINT AS work_tokens, sum(cache_read)::BIGINT AS reread_tokens FROM ({_USAGE}) GROUP BY GROUPING SETS ((unit), (stage), ())""",
)
def usage_grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token streams by unit, by stage and in all."""
    return accounting.account(_usage(spark, sf_dir))


@query("usage_projection", f"SELECT count(DISTINCT unit) AS n_units, sum(input + cache_write + output)::BIGINT AS work_tokens, round_even(sum(input + cache_write + output)::DOUBLE / count(DISTINCT unit), 1) AS mean_per_unit, round_even(sum(input + cache_write + output)::DOUBLE / count(DISTINCT unit) * 1000, 0)::BIGINT AS projected, round_even((3.0::DOUBLE * sum(input) + 15.0::DOUBLE * sum(output)) / 1000000, 4) AS price FROM ({_USAGE})")
def usage_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean use a unit, and what a thousand units would use."""
    return accounting.projection(_usage(spark, sf_dir), 1000, dict(input=3.0, output=15.0))


@query(
    "fuse_running",
    f"""SELECT event_id, unit, calls, tokens::BIGINT AS tokens, CASE WHEN calls > 40 THEN 'calls' WHEN tokens > 5000 THEN 'tokens' END AS tripped, (calls > 40 OR tokens > 5000) AND (calls = 41 OR (tokens > 5000 AND tokens - w <= 5000)) AS first_trip
FROM (SELECT event_id, unit, input + cache_write + output AS w, count(*) OVER o AS calls, sum(input + cache_write + output) OVER o AS tokens FROM ({_USAGE}) WINDOW o AS (PARTITION BY unit ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING))""",
)
def fuse_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each unit's running use passes a ceiling."""
    return accounting.fuse(_usage(spark, sf_dir), ["ts", "event_id"], 40, 5000, scope="unit").select("event_id", "unit", "calls", "tokens", "tripped", "first_trip")


@query(
    "rank_manual_queue",
    """WITH i AS (SELECT CAST(doc_id AS STRING) AS doi, split_part(text, chr(10), 1) AS title, text AS abstract, 2000 + CAST(doc_id % 24 AS INT) AS year, CAST(n_chars % 300 AS INT) AS cited_by FROM documents),
t AS (SELECT *, list_filter(['license', 'stupid', 'with'], lambda x: contains(lower(title), x)) AS tt, list_filter(['license', 'stupid', 'with'], lambda x: contains(lower(abstract), x) AND NOT contains(lower(title), x)) AS ta, (SELECT max(year) FROM i) AS newest FROM i)
SELECT doi, year, cited_by, round_even(2.0::DOUBLE * len(tt) + len(ta) + 1.5::DOUBLE * greatest(0.0::DOUBLE, 1 - (newest - year) / 10.0::DOUBLE) + ln(1 + cited_by::DOUBLE) / 4.61512051684126::DOUBLE, 3) AS score, array_to_string(tt, ',') AS terms_in_title, array_to_string(ta, ',') AS terms_in_abstract
FROM t ORDER BY score DESC, doi LIMIT 25""",
)
def rank_manual_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty-five sources most worth a person's time."""
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("doi"), F.substring_index("text", "\n", 1).alias("title"), F.col("text").alias("abstract"), (F.lit(2000) + F.col("doc_id") % 24).cast("int").alias("year"), (F.col("n_chars") % 300).cast("int").alias("cited_by"))
    out = corpus.rank_manual(d, ["license", "stupid", "with"])
    return out.select("doi", "year", "cited_by", "score", F.array_join("terms_in_title", ",").alias("terms_in_title"), F.array_join("terms_in_abstract", ",").alias("terms_in_abstract"))


@query(
    "mapping_validation",
    "SELECT p_partkey, (p_size BETWEEN 5 AND 40)::INT::DOUBLE AS c_grounded, p_size BETWEEN 5 AND 40 AS size_ok, p_type IN ('LARGE', 'MEDIUM', 'SMALL') AS type_ok, CASE WHEN NOT p_size BETWEEN 5 AND 40 THEN 'out_of_range' ELSE '' END AS flags FROM part",
)
def mapping_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values outside their declared range or vocabulary: flagged, not dropped."""
    size = mapping.validate(F.concat(F.col("p_size").cast("string"), F.lit(" cm")), "float", (5, 40))
    kind = mapping.validate(F.col("p_type"), "enum", enum=["LARGE", "MEDIUM", "SMALL"])
    return table(spark, sf_dir, "part").select("p_partkey", size["c_grounded"].alias("c_grounded"), size["ok"].alias("size_ok"), kind["ok"].alias("type_ok"), F.array_join(size["flags"], ",").alias("flags"))


@query(
    "export_pivot",
    "SELECT l_orderkey, arg_min(CAST(CAST(l_quantity AS INT) AS STRING), l_partkey * 1000000 + l_suppkey) FILTER (l_linenumber = 1) AS f1, arg_min(CAST(CAST(l_quantity AS INT) AS STRING), l_partkey * 1000000 + l_suppkey) FILTER (l_linenumber = 2) AS f2, arg_min(CAST(CAST(l_quantity AS INT) AS STRING), l_partkey * 1000000 + l_suppkey) FILTER (l_linenumber = 7) AS f7 FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, min(l_quantity) AS l_quantity FROM lineitem GROUP BY ALL) GROUP BY l_orderkey",
)
def export_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields as columns."""
    li = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").agg(F.min("l_quantity").alias("l_quantity"))
    long = li.select("l_orderkey", F.expr("'f' || CAST(l_linenumber AS STRING)").alias("field_name"), F.expr("CAST(CAST(l_quantity AS INT) AS STRING)").alias("value"), F.expr("l_partkey * 1000000 + l_suppkey").alias("ord"))
    return review.wide_fields(long, ["l_orderkey"], ["f1", "f2", "f7"])


@query("theme_groups", "SELECT CASE WHEN lang IN ('en', 'de') THEN lang ELSE 'unassigned' END AS theme, count(*) AS n_claims, count(DISTINCT source) AS n_sources FROM documents GROUP BY 1")
def theme_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims and sources of each declared theme."""
    claims = table(spark, sf_dir, "documents").select(F.col("lang").alias("theme"), F.col("source").alias("source_id"))
    return review.theme_groups(claims, spark.createDataFrame([("en",), ("de",)], "theme string"))


@query(
    "question_catalogue",
    f"""WITH f AS (SELECT CAST(rec % 10 AS STRING) AS source_id, CAST(rec AS STRING) || '/' || field_name AS at_, * FROM ({src.SCORED_SQL})), r AS (SELECT rec, count(*) AS n FROM f GROUP BY rec)
SELECT DISTINCT source_id, 'passes_disagree' AS kind, at_ AS detail FROM f WHERE c_ensemble < 1
UNION SELECT source_id, 'value_not_in_quote', at_ FROM f WHERE c_grounded <= 0 UNION SELECT source_id, 'value_partly_in_quote', at_ FROM f WHERE c_grounded > 0 AND c_grounded < 1
UNION SELECT source_id, 'contradicted', at_ FROM f WHERE n_contradictions > 0 UNION SELECT source_id, 'not_searched', at_ FROM f WHERE contradiction_search = 'not_run'
UNION SELECT CAST(rec % 10 AS STRING), 'missed_by_a_pass', CAST(rec AS STRING) FROM r WHERE n % 3 + 1 < 3""",
)
def question_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a person may have to settle."""
    f = src.scored_fields(spark, sf_dir).select((F.col("rec") % 10).cast("string").alias("source_id"), F.col("rec").cast("string").alias("record_id"), "field_name", F.lit(False).alias("ambiguous"), "c_ensemble", "c_grounded", "n_contradictions", "contradiction_search", F.lit(False).alias("is_inferential"))
    r = f.groupBy("source_id", "record_id").agg(F.count("*").alias("n_fields")).select("*", F.lit(False).alias("review_only"), (F.col("n_fields") % 3 + 1).alias("found_by_passes"), F.lit(3).alias("k"))
    return selection.question_catalogue(f, r)


@query("normalized_ids", "SELECT page_id, regexp_replace(url, '[^A-Za-z0-9._-]', '_', 'g') AS dirname, lower(regexp_replace(trim(url), '^https?://(dx\\.)?doi\\.org/', '')) AS doi FROM pages")
def normalized_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Directory names and DOIs of identifiers."""
    return table(spark, sf_dir, "pages").select("page_id", tx.dirname(F.col("url")).alias("dirname"), tx.normalize_doi(F.col("url")).alias("doi"))


@query(
    "source_status",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'retracted' WHEN o_orderkey % 3 = 0 THEN 'superseded' WHEN o_orderkey % 2 = 0 THEN 'corrected' ELSE 'active' END AS status FROM orders""",
)
def source_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status of a source from its notices, in order."""
    rels = F.filter(F.array(F.when(F.col("o_orderkey") % 2 == 0, "Erratum"), F.when(F.col("o_orderkey") % 3 == 0, "new_version"), F.when(F.col("o_orderkey") % 5 == 0, "comment"), F.when(F.col("o_orderkey") % 7 == 0, "retraction"), F.when(F.col("o_orderkey") % 14 == 0, "correction")), lambda r: r.isNotNull())
    return table(spark, sf_dir, "orders").select("o_orderkey", corpus.status_from_relations(rels).alias("status"))


@query("source_counts", f"SELECT source_id, count(*) AS n_found, count(*) FILTER (decision = 'allowed') AS n_accepted FROM ({_CANDIDATES}) GROUP BY source_id")
def source_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records found and accepted for each source."""
    return reports.source_counts(_candidates(spark, sf_dir))


_COPIES = "SELECT l_orderkey AS doi, 'u' || CAST(l_partkey AS STRING) || '/' || CAST(l_suppkey AS STRING) AS url, CASE l_linenumber % 3 WHEN 0 THEN 'publishedVersion' WHEN 1 THEN 'acceptedVersion' ELSE 'submittedVersion' END AS version, CASE WHEN l_suppkey % 5 = 0 THEN 'unreachable' ELSE 'answered' END AS state FROM lineitem"


@query(
    "resolve_access",
    f"""WITH c AS (SELECT doi, url, version, row_number() OVER (PARTITION BY doi ORDER BY CASE version WHEN 'publishedVersion' THEN 0 WHEN 'acceptedVersion' THEN 1 ELSE 2 END, url) AS k FROM ({_COPIES}) WHERE state = 'answered')
SELECT o_orderkey AS doi, c.url, c.version, c.url IS NOT NULL AS open, coalesce(c.version = 'publishedVersion', false) AS auto_acceptable FROM orders LEFT JOIN c ON c.doi = o_orderkey AND c.k = 1""",
)
def resolve_access(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best open copy of each paper; no answer leaves it closed."""
    copies = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey AS doi", "'u' || CAST(l_partkey AS STRING) || '/' || CAST(l_suppkey AS STRING) AS url", "CASE l_linenumber % 3 WHEN 0 THEN 'publishedVersion' WHEN 1 THEN 'acceptedVersion' ELSE 'submittedVersion' END AS version", "CASE WHEN l_suppkey % 5 = 0 THEN 'unreachable' ELSE 'answered' END AS state")
    return search.resolve_access(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doi")), copies)


@query(
    "retraction_check",
    """SELECT o_orderkey AS doi, o_orderkey % 4 <> 0 AS ok, CASE WHEN o_orderkey % 4 <> 0 THEN CASE WHEN o_orderkey % 11 = 0 THEN 'retracted' WHEN o_orderkey % 3 = 0 THEN 'corrected' ELSE 'active' END END AS status FROM orders""",
)
def retraction_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status of each paper by its notices; unknown where nothing answered."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doi"))
    rels = F.filter(F.array(F.when(F.col("doi") % 3 == 0, "correction"), F.when(F.col("doi") % 11 == 0, "withdrawal"), F.when(F.col("doi") % 2 == 0, "erratum_note")), lambda r: r.isNotNull())
    notices = o.select("doi", rels.alias("relations"), F.when(F.col("doi") % 4 == 0, "unreachable").otherwise("answered").alias("state"))
    return search.check_retractions(o, notices)


@query("theme_report", "SELECT CASE WHEN lang IN ('en', 'de') THEN lang ELSE 'unassigned' END AS theme, count(*) AS n_claims, count(DISTINCT source) AS n_sources, least(count(*), 400) AS n_lines FROM documents GROUP BY 1")
def theme_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections of a report by theme; a section lists four hundred claims at most."""
    claims = table(spark, sf_dir, "documents").select(F.col("source").alias("source_id"), F.col("doc_id").cast("string").alias("record_id"), F.col("doc_id").cast("string").alias("claim"), F.col("lang").alias("theme"))
    out = reports.theme_sections(claims, spark.createDataFrame([("en", "English"), ("de", "German")], "theme string, definition string"))
    return out.select("theme", "n_claims", "n_sources", F.size(F.filter(F.split("markdown", "\n"), lambda x: x.startswith("- "))).cast("long").alias("n_lines"))
