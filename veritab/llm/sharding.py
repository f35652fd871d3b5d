"""Sharding by a Feistel permutation of global row numbers, walked along its cycles. SQL functions only.

Rows get global numbers in the order of (doc_id, size, crc): a range sort, the
row's place in its partition, and the partition's offset from a count of rows
a partition. The permutation acts on a x b >= n numbers with a, b close to
sqrt(n), so at most a numbers lie outside and are walked on. The permuted
number p gives shard p mod shards and slot p div shards: counts differ by one
at most, slots are gapless, and a row's place can be computed from its number
alone. Rows that are equal in all three columns are interchangeable, so the
result doesn't depend on how the table is split into files.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritab.llm.common import cut, prepare

SHARDS, ROUNDS, SEED = 40, 6, 20240229
#: Steps of cycle walking. All of at most a numbers outside lie on cycles, so up to 64 rows this is enough by count; beyond, a longer walk has probability under n^-32. It is an error, not a wrong place.
WALK = 64


def feistel_sql(x: str, n: int, rounds: int = ROUNDS, seed: int = SEED) -> str:
    """SQL of one pass of the permutation over [0, a x b) for an expression x, with a = ceil(sqrt n), b = ceil(n / a).

    Each round swaps the halves and adds 48 bits of a keyed md5 of one to the
    other, modulo a and b in turn; `rounds` is even, so the halves end where
    they began.
    """
    a = max(1, math.isqrt(max(n, 1) - 1) + 1)
    b = -(-max(n, 1) // a)
    keyed = f"cast(conv(substr(md5(concat_ws(':', '{seed}', k, s.r)), 1, 12), 16, 10) as bigint)"
    step = f"named_struct('l', s.r, 'r', pmod(s.l + {keyed}, if(k % 2 = 0, {a}L, {b}L)))"
    return f"aggregate(sequence(0, {rounds - 1}), named_struct('l', pmod({x}, {a}L), 'r', ({x}) div {a}L), (s, k) -> {step}, s -> s.r * {a}L + s.l)"


def permuted(row_number: str, n: int, rounds: int = ROUNDS, seed: int = SEED) -> Column:
    """Place of a row number in [0, n) under the permutation, walking on while it is outside."""
    first = feistel_sql(row_number, n, rounds, seed)
    walk = f"aggregate(sequence(1, {WALK}), {first}, (p, i) -> if(p < {n}L, p, {feistel_sql('p', n, rounds, seed)}), p -> if(p < {n}L, p, raise_error('cycle walk too long')))"
    return F.expr(walk).cast("long")


def numbered(rows: DataFrame, order: list[str], name: str = "row_number") -> tuple[DataFrame, int]:
    """`rows` with global row numbers from 0 in `order`, and how many there are; the sort is checkpointed.

    Only a count for each partition is windowed; it is broadcast, and its size
    is the number of partitions.
    """
    spread = cut(rows.repartitionByRange(*[F.col(c).asc_nulls_first() for c in order]).sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in order]).withColumn("_at", F.monotonically_increasing_id()))
    split = spread.withColumn("_part", F.shiftright("_at", 33)).withColumn("_in", F.col("_at").bitwiseAND((1 << 33) - 1))
    counts = split.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut(counts.select("_part", "_n", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base")))
    n = offsets.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    out = split.join(F.broadcast(offsets.drop("_n")), "_part").withColumn(name, F.col("_base") + F.col("_in"))
    return out.drop("_part", "_at", "_in", "_base"), n


def shards(docs: DataFrame, count: int = SHARDS, rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row.

    size is the text's UTF-8 bytes (null: none) plus 16, text_crc32 that of
    those bytes. The law is "rows": shards differ by one row at most, and
    grown_shard is null. Ties in doc_id are ordered by size and crc; a null
    doc_id comes first. An empty table gives no rows.
    """
    prepare(docs.sparkSession)
    raw = F.encode(F.coalesce(F.col("text").cast("string"), F.lit("")), "UTF-8")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(raw) + 16).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"))
    out, n = numbered(rows, ["doc_id", "size", "text_crc32"])
    placed = out.withColumn("_p", permuted("row_number", n, rounds, seed))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), (F.col("_p") % count).cast("int").alias("shard"), F.expr(f"_p div {int(count)}").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
