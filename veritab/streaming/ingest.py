"""Streams over the same operators: gated upserts, first sight of identifiers, and running ceilings.

Nothing here decides differently from the batch operators; a stream only brings
rows in smaller lots. State is bounded by watermarks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from veritab.operators.accounting import Fuse
from veritab.sources.tables import OutputTables


def read_stream(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 8) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def _timed(rows: DataFrame, at: str) -> DataFrame:
    """Event times without a zone are read in the session's."""
    return rows.withColumn(at, F.col(at).cast("timestamp"))


def first_seen(rows: DataFrame, keys: list[str], at: str, delay: str) -> DataFrame:
    """Rows whose key hasn't come before within the watermark: a repeated delivery is dropped."""
    return _timed(rows, at).withWatermark(at, delay).dropDuplicatesWithinWatermark(keys)


def windowed_usage(rows: DataFrame, at: str = "ts", delay: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Calls and tokens by stage in windows of time; a window closes when the watermark passes it."""
    return _timed(rows, at).withWatermark(at, delay).groupBy(F.window(at, width), "stage").agg(F.count("*").alias("calls"), F.sum("tokens").alias("tokens"))


def run_available(rows: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None], mode: str = "append") -> StreamingQuery:
    """Feed all that is there to `each`, batch by batch, and stop; what was done is kept in `checkpoint`, so a rerun resumes after it."""
    query = rows.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(each).start()
    query.awaitTermination()
    return query


def upsert_stream(rows: DataFrame, tables: OutputTables, checkpoint: str, gate: Callable[[DataFrame], DataFrame]) -> StreamingQuery:
    """Gate and write a stream of records. A batch that is run again finds its rows written, and identical ones change nothing."""
    return run_available(rows, checkpoint, lambda batch, _: tables.upsert(gate(batch)) and None)


def fused(each: Callable[[DataFrame, int], None], fuse: Fuse, tokens: str = "tokens") -> Callable[[DataFrame, int], None]:
    """`each` under ceilings: a batch's tokens are counted first, and one that passes a ceiling isn't run."""

    def run(batch: DataFrame, number: int) -> None:
        fuse.record(int(batch.agg(F.coalesce(F.sum(tokens), F.lit(0))).first()[0]))
        each(batch, number)

    return run


def pending(sources: DataFrame, done: DataFrame) -> DataFrame:
    """Sources still to do: those without a finished run. A recorded negative is finished; a skipped stage isn't."""
    finished = done.where(F.col("state").isin("done", "empty")).select("source_id").distinct()
    return sources.join(finished, "source_id", "left_anti")
