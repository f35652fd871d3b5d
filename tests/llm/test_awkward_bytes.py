"""Bytes that aren't UTF-8, very long texts without a line end, and tables whose every row lacks an id."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from veritab.llm import licences, linededup, minhash, mixing, packing, quality, sharding, spotsigs, toxicity


@pytest.fixture(scope="module")
def odd(spark):
    """Row 1 holds a byte that no UTF-8 text has; row 4 is one line of 400,000 signs."""
    rows = [(1, None), (2, "plain words of a plain text that nobody has written twice"), (3, None), (4, "long " * 80_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"source": F.lit("s"), "lang": F.lit("en")})
    return docs.withColumn("text", F.when(F.col("doc_id") == 1, F.expr("cast(X'776f726420ff20776f7264' as string)")).otherwise(F.col("text")))


def test_every_operator_takes_them(spark, odd):
    labels = spark.createDataFrame([(k, k % 2, k % 2) for k in range(6)], "doc_id long, quality int, toxic int")
    assert spotsigs.edit_likeness(odd).count() == 4
    assert licences.scan_documents(odd).count() == 4
    assert quality.quality(odd, labels).count() == 4
    assert toxicity.toxicity(odd, labels).count() == 4
    assert sharding.shards(odd).count() == 4
    assert packing.pack(odd).select("doc_id").distinct().count() == 4
    assert mixing.mixture(odd).select("doc_id").distinct().count() == 4
    assert minhash.near_duplicates(odd).count() == 4
    kept = {r["doc_id"]: r["kept_sha256"] for r in linededup.line_digests(odd).collect()}
    assert kept[1] == hashlib.sha256(b"word \xff word").hexdigest()


def test_a_table_without_ids(spark):
    rows = [(None, f"a line that stands in every one of these rows\nrow {k % 2}") for k in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert linededup.drop_repeated_lines(docs).count() == 8
    assert minhash.drop_near_duplicates(docs).count() == 8
    assert {r["component_id"] for r in minhash.near_duplicates(docs).collect()} == {None}


def test_licence_query_against_a_loop(spark, awkward):
    """Every row's scan by itself, and its path's ancestors one after another."""
    own, rows = licences.Templates(), []
    extra = [(k, "Released under the MIT License." if k in (64, 128, 256) else "prose", "en", "src0", 5) for k in (64, 128, 192, 256, 300, 512, 600)]
    docs = awkward.unionByName(spark.createDataFrame(extra, awkward.schema))
    for r in licences.document_files(docs).collect():
        score, name = own.scan(r["text"], licences.COSINE)
        rows.append((r["file_id"], r["path"], name if score >= licences.COSINE else None, round(score, 6)))
    held: dict[str, tuple] = {}
    for _, path, name, score in rows:
        if path is not None and name is not None and path.rsplit("/", 1)[-1].startswith("LICENSE"):
            folder = path.rsplit("/", 1)[0]
            held[folder] = min(held.get(folder, (1, "")), (-score, name))
    want = []
    for ident, path, name, score in rows:
        licence, above, up = name, None, 0 if name is not None else None
        if name is None and path is not None:
            parts = path.split("/")[:-1]
            for n in range(len(parts), 0, -1):
                if (folder := "/".join(parts[:n])) in held:
                    licence, above, up = held[folder][1], folder, len(parts) - n + 1
                    break
        want.append((ident, path, name, score, licence, above, up))
    got = licences.scan_documents(docs).select("doc_id", "path", "own_licence", "cosine", "licence", "inherited_from", "levels_up").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert {r["levels_up"] for r in got} >= {0, 1, 2, None}
