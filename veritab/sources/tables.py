"""The three output tables as append-only Parquet logs, resolved when they are read.

A write adds files and never rewrites any, so a lost job leaves whole rows or
none; which row of a key stands is decided at reading: the first for accepted
records (they are never changed), the last for candidates and rulings.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from veritab.operators.graph import checkpointed
from veritab.operators.review import KEY, last_writer, qualified_id, resolve_upserts, ruling, writable

SCHEMAS = {
    "records": "record_id string, source_id string, entity_type string, route string, source_status string, composite double, payload string, written_at string, seq long",
    "candidates": "record_id string, source_id string, entity_type string, composite double, decision string, codes array<string>, judge_verdict string, payload string, recorded_at string, seq long",
    "adjudications": "record_id string, source_id string, verdict string, note string, adjudicator string, at string, seq long",
}


@dataclass
class OutputTables:
    spark: SparkSession
    path: str

    def _read(self, name: str) -> DataFrame:
        try:
            return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.path}/{name}")
        except AnalysisException:
            return self.spark.createDataFrame([], SCHEMAS[name])

    def _append(self, name: str, rows: DataFrame) -> None:
        shape = self.spark.createDataFrame([], SCHEMAS[name]).schema
        rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in shape]).write.mode("append").parquet(f"{self.path}/{name}")

    def records(self) -> DataFrame:
        """Accepted records: the first of each id."""
        rows = self._read("records")
        return rows.groupBy("record_id").agg(F.min_by(F.struct(*[c for c in rows.columns if c != "record_id"]), "seq").alias("_r")).select("record_id", "_r.*")

    def candidates(self) -> DataFrame:
        return last_writer(self._read("candidates"), KEY, "seq")

    def adjudications(self) -> DataFrame:
        return last_writer(self._read("adjudications"), KEY, "seq")

    def upsert(self, gated: DataFrame, lane: Sequence[str] = ()) -> DataFrame:
        """Write those of `gated` (record columns, allowed boolean) that the gate lets in; returns each with its outcome (written, identical, collision or denied) and why it was refused.

        With a `fields` column the payload is made here, without the fields of
        the lane; see `writable`. A record must name its source; its id is
        qualified by it. A second writer may append the same id at the same
        time: which one stands is settled when the table is read.
        """
        if "fields" in gated.columns:
            whole = writable(gated, lane)
        else:
            named = F.coalesce(F.trim("source_id"), F.lit("")) != ""
            whole = gated.withColumn("refused", F.when(~F.coalesce("allowed", F.lit(False)), "gate").when(~named, "no_source")).withColumn("record_id", qualified_id(F.col("source_id"), F.col("record_id")))
        fit = resolve_upserts(whole.where("refused is null"), self.records())
        decided = checkpointed(fit.unionByName(whole.where("refused is not null").withColumn("outcome", F.lit("denied"))))
        self._append("records", decided.where("outcome = 'written'"))
        return decided

    def record_candidates(self, rows: DataFrame) -> None:
        self._append("candidates", rows)

    def record_adjudications(self, rows: DataFrame) -> DataFrame:
        """Write rulings with a known verdict; returns those that were refused."""
        said = rows.withColumn("_said", ruling(F.col("verdict")))
        self._append("adjudications", said.where("_said is not null").withColumn("verdict", F.col("_said")))
        return said.where("_said is null").drop("_said")
