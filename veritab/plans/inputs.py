"""Inputs that queries derive from the driver's tables by SQL that Spark and DuckDB read alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """`df` over all cores where its files give fewer splits than there are, as one small file does; tables of many splits stay as they are.

    For steps that work long on each row: the rows are narrow, moving them is
    cheaper than leaving cores idle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df._jdf.queryExecution().toRdd().getNumPartitions() < cores else df


#: Bytes of input files for a partition of rows that are laid out once; few, because what is made of them is many times as wide.
LAID_BYTES = 512 << 10


def laid_parts(of: DataFrame) -> int:
    """Partitions to lay out a table's rows in: those of the session, or more where its files are large.

    A number that is said is kept, so that small partitions aren't put together
    again before their rows have grown.
    """
    size = int(str(of._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))  # of the files; nothing is read for it
    known = 0 < size < 1 << 60  # tables that aren't files have no known size
    return min(10_000, max(int(of.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // LAID_BYTES if known else 1))


#: Three passes over the price of a line item: the second strays by up to 5 %, the third is at times missing.
PASS_1 = "l_extendedprice"
PASS_2 = "l_extendedprice * CASE l_orderkey % 3 WHEN 0 THEN CAST(1 AS DOUBLE) WHEN 1 THEN CAST(1.004 AS DOUBLE) ELSE CAST(1.05 AS DOUBLE) END"
PASS_3 = "CASE WHEN l_orderkey % 5 = 0 THEN CAST(NULL AS DOUBLE) ELSE l_extendedprice END"

#: Signals of a field made of a line item.
GROUNDED = "CASE WHEN (l_orderkey + l_linenumber) % 11 = 0 THEN CAST(0.5 AS DOUBLE) WHEN l_partkey % 13 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END"
ENSEMBLE = "CASE WHEN l_suppkey % 7 = 0 THEN CAST(2 AS DOUBLE) / 3 WHEN l_suppkey % 19 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END"
CONTRADICTIONS = "CASE WHEN l_returnflag = 'R' AND l_linenumber = 3 AND l_partkey % 5 = 0 THEN 1 ELSE 0 END"
SEARCH = "CASE WHEN l_orderkey % 17 = 0 THEN 'not_run' ELSE 'clean' END"
STATUS = "CASE WHEN o_orderstatus = 'P' AND o_orderkey % 2 = 0 THEN 'retracted' WHEN o_orderkey % 29 = 0 THEN CAST(NULL AS STRING) ELSE 'active' END"
VERDICT = "CASE o_orderpriority WHEN '1-URGENT' THEN 'supported' WHEN '2-HIGH' THEN ' Supported' WHEN '3-MEDIUM' THEN 'supported' WHEN '4-NOT SPECIFIED' THEN 'partial' ELSE CAST(NULL AS STRING) END"
#: Field number 7 is the review lane; 1 is locked; two fields at least must be populated.
LANE, LOCKED, LEAST = "f7", "f1", 2


def scored_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A field for each line item: its record, signals, contradictions and number."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("rec"), F.expr("'f' || CAST(l_linenumber AS STRING)").alias("field_name"), F.expr(GROUNDED).alias("c_grounded"), F.expr(ENSEMBLE).alias("c_ensemble"),
        F.expr(CONTRADICTIONS).alias("n_contradictions"), F.expr(SEARCH).alias("contradiction_search"), F.expr("CAST(CAST(l_quantity AS INT) AS STRING)").alias("value"),
    )


SCORED_SQL = f"""SELECT l_orderkey AS rec, 'f' || CAST(l_linenumber AS STRING) AS field_name, {GROUNDED} AS c_grounded, {ENSEMBLE} AS c_ensemble,
  {CONTRADICTIONS} AS n_contradictions, {SEARCH} AS contradiction_search FROM lineitem"""
CONFIDENCE_SQL = "(CAST(0.35 AS DOUBLE) * c_grounded + CAST(0.15 AS DOUBLE) * c_ensemble) / (CAST(0.35 AS DOUBLE) + CAST(0.15 AS DOUBLE))"
ROUTE_SQL = """CASE WHEN n_contradictions > 0 THEN 'human_review' WHEN c_ensemble >= 1 - 1e-9 AND c_grounded >= 0.9 THEN 'auto_accept'
  WHEN (c_grounded >= 0.6 AND c_grounded < 0.9) OR (c_ensemble > 0 AND c_ensemble < 1 - 1e-9) THEN 'cheap_repair' ELSE 'human_review' END"""

#: Documents as candidates: a score of a hundred steps, a source of twenty, and a ruling from the labels.
SCORE = "CAST((n_chars * 7 + doc_id) % 100 AS DOUBLE) / 100"
RULING = "CASE WHEN toxic = 1 AND quality = 1 THEN 'cant_tell' WHEN quality = 1 THEN 'right' ELSE 'wrong' END"
RULINGS_SQL = f"SELECT doc_id, {RULING} AS verdict FROM (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id)"


def rulings(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    return own.select("doc_id", F.expr(RULING).alias("verdict"))


def scored_rulings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars", F.expr(SCORE).alias("score"))
    return docs.join(rulings(spark, sf_dir), "doc_id")
