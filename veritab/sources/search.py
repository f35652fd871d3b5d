"""A literature search as a Spark data source: pages follow a cursor; the getter that fetches them is injected.

    spark.dataSource.register(search_source(getter))
    spark.read.format("veritab_search").option("query", q).option("limit", 500).load()

`getter(query, cursor)` returns (hits, next cursor or None). No getter that
talks to a network is part of this package.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader

from veritab.operators.order import numbered

Getter = Callable[[str, "str | None"], tuple[list[dict], "str | None"]]


def pages(query: str, limit: int, getter: Getter) -> Iterator[dict]:
    """Hits in order, `limit` at most; a cursor that comes again ends the search."""
    cursor, seen, n = None, {None}, 0
    while n < limit:
        hits, cursor = getter(query, cursor)
        for hit in hits[: limit - n]:
            n += 1
            yield hit
        if not hits or cursor in seen:
            return
        seen.add(cursor)


def search_source(getter: Getter) -> type[DataSource]:
    """A data source class over a getter; its rows are (ord long, value string), the hit as JSON."""

    class Reader(DataSourceReader):
        def __init__(self, options: dict):
            self.query, self.limit = options["query"], int(options.get("limit", 1000))

        def read(self, partition):
            for k, hit in enumerate(pages(self.query, self.limit, getter)):
                yield k, json.dumps(hit)

    class Search(DataSource):
        @classmethod
        def name(cls) -> str:
            return "veritab_search"

        def schema(self) -> str:
            return "ord long, value string"

        def reader(self, schema) -> DataSourceReader:
            return Reader(self.options)

    return Search


def saved_search(spark: SparkSession, path: str) -> DataFrame:
    """Hits of a saved search: JSON lines, numbered from 0 in their order in the files."""
    at = [F.col("_metadata.file_path").alias("_f"), F.col("_metadata.file_block_start").alias("_b"), F.monotonically_increasing_id().alias("_i")]
    rows = spark.read.text(path).select("value", *at)
    return numbered(rows, [F.col("_f"), F.col("_b"), F.col("_i")], "_n").select((F.col("_n") - 1).alias("ord"), "value")


def carry_forward(found: DataFrame, before: DataFrame) -> DataFrame:
    """A search's papers with local copies that an earlier one held and this one doesn't."""
    kept = before.where("route = 'local_pdf'").join(found.select("source_id"), "source_id", "left_anti")
    return found.unionByName(kept, allowMissingColumns=True)


def add_local(existing: DataFrame, added: DataFrame) -> DataFrame:
    """Local copies (source_id, sha256) with what adding each does: added, identical, or conflict (another file under a stored id); the stored one stands."""
    held = existing.select("source_id", F.col("sha256").alias("_sha"))
    out = added.join(held, "source_id", "left")
    return out.withColumn("outcome", F.when(F.col("_sha").isNull(), "added").when(F.col("_sha") == F.col("sha256"), "identical").otherwise("conflict")).drop("_sha")


VERSIONS = ("publishedVersion", "acceptedVersion", "submittedVersion")


def resolve_access(papers: DataFrame, copies: DataFrame) -> DataFrame:
    """Each paper's best open copy (version first, then address) from a lookup table (doi, url, version, state); anything but an answer leaves it closed."""
    rank = F.create_map(*[x for k, v in enumerate(VERSIONS) for x in (F.lit(v), F.lit(k))])
    open_ = copies.where("state = 'answered' and url is not null").groupBy("doi").agg(F.min(F.struct(F.coalesce(rank[F.col("version")], F.lit(len(VERSIONS))).alias("r"), "url", "version")).alias("c"))
    out = papers.join(open_, "doi", "left")
    return out.select(*papers.columns, F.col("c.url").alias("url"), F.col("c.version").alias("version"), F.col("c").isNotNull().alias("open"), F.coalesce(F.col("c.version") == VERSIONS[0], F.lit(False)).alias("auto_acceptable"))


def check_retractions(papers: DataFrame, notices: DataFrame) -> DataFrame:
    """Each paper's status from a lookup table (doi, relations, state); unanswered ones are unknown, which isn't active."""
    from veritab.operators.corpus import status_from_relations

    told = notices.where("state = 'answered'").select("doi", "relations", F.lit(True).alias("_ok"))
    out = papers.join(told, "doi", "left")
    return out.select(*papers.columns, F.coalesce("_ok", F.lit(False)).alias("ok"), F.when(F.col("_ok"), status_from_relations(F.col("relations"))).alias("status"))
