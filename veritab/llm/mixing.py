"""Mixing sources to target weights by temperature. DataFrame and SQL functions only.

Source token shares p are raised to an exponent x in [0, 1] and normalised.
x is bisected to the least value at which the entropy has come down to the
target and no source is read more than `max_epochs` times. Each source then
has a quota of tokens: whole epochs, and a part of one more. An epoch is a
block permutation: documents hash into blocks of about BLOCK, blocks are
ordered by a hash of the epoch, and documents in a block likewise. A part of an
epoch is a prefix of that order, so only each source's boundary block is
sorted, and every document can tell its copies from one row a source: a source
that holds a third of all rows is never gathered.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritab.llm.common import cut, fresh, prepare, quoted

BLOCK, SEED = 4096, 20240301
#: Target entropy as a share of that of equal weights, and the most times that a document may be read.
ENTROPY, MAX_EPOCHS = 0.9, 2.0
#: Interior points of one pass: five halvings of the interval are read from one aggregation.
POINTS, PASSES = 31, 9
#: Rows of the table of sources that are broadcast at most; beyond, it is joined by shuffle.
BROADCAST_SOURCES = 50_000
WORDS = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Words as maximal runs outside [\\x20\\x09-\\x0D]; null: none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def bisect_exponent(sources: DataFrame, entropy: float, max_epochs: float) -> float:
    """The exponent for `sources` (tokens long), rounded to nine decimals.

    Every pass is one aggregation over the sources with one row to the driver.
    """
    full = sources.where("tokens > 0").agg(F.sum("tokens").cast("double").alias("t"), F.max("tokens").alias("hi"), F.min("tokens").alias("lo"), F.count("*").alias("n")).first()
    if not full["n"]:
        return 1.0
    goal, ratio = entropy * math.log(full["n"]), full["hi"] / full["lo"]
    share = F.col("tokens") / F.lit(full["t"])

    def settled(points: list[float]) -> list[bool]:
        sums = [F.sum(F.pow(share, F.lit(x))) for x in points] + [F.sum(F.pow(share, F.lit(x)) * F.log(share)) for x in points]
        row = sources.where("tokens > 0").agg(*[s.alias(f"s{k}") for k, s in enumerate(sums)]).first()
        k = len(points)
        return [math.log(row[i]) - x * row[k + i] / row[i] <= goal and ratio ** (1 - x) <= max_epochs for i, x in enumerate(points)]

    lo, hi = 0.0, 1.0
    if settled([0.0])[0]:
        return 0.0
    for _ in range(PASSES):
        points = [lo + (hi - lo) * k / (POINTS + 1) for k in range(1, POINTS + 1)]
        first = next((k for k, ok in enumerate(settled(points)) if ok), POINTS)
        lo, hi = (points[first - 1] if first else lo), (points[first] if first < POINTS else hi)
    return round(hi, 9)


def _block(seed: int, ident: str, blocks: str) -> Column:
    return F.expr(f"cast(pmod(cast(conv(substr(md5(concat_ws(':', '{seed}', 'block', {ident})), 1, 12), 16, 10) as bigint), {blocks}) as int)")


def _block_key(seed: int, source: str, epoch: str, block: str) -> Column:
    return F.expr(f"md5(concat_ws(':', '{seed}', 'order', {source}, {epoch}, {block}))")


def _doc_key(seed: int, epoch: str, ident: str) -> Column:
    return F.expr(f"md5(concat_ws(':', '{seed}', 'doc', {epoch}, {ident}))")


def plan(light: DataFrame, entropy: float = ENTROPY, max_epochs: float = MAX_EPOCHS, budget: int | None = None, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """One row a source of `light` (id long, source string, tokens long): weight, whole epochs, and where its last, partial epoch ends.

    Columns: source, tokens, weight, blocks, whole, edge_key, edge_block, cut_key, cut_id.
    Without a budget, it is the least at which each source is read once in
    whole, so that mixing loses no document.
    """
    sums = cut(light.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("n")))
    x = bisect_exponent(sums, entropy, max_epochs)
    all_ = sums.where("tokens > 0").agg(F.max("tokens").cast("double").alias("top"), F.sum(F.pow(F.col("tokens").cast("double"), F.lit(x))).alias("z")).first()
    top, z = all_["top"] or 1.0, all_["z"] or 1.0
    tokens = F.col("tokens").cast("double")
    quota = F.floor(F.pow(tokens / F.lit(top), F.lit(x - 1.0)) * tokens) if budget is None else F.floor(F.pow(tokens, F.lit(x)) / F.lit(z) * F.lit(float(budget)))
    live = F.col("tokens") > 0
    sums = sums.select(
        "source", "tokens", F.ceil(F.col("n") / F.lit(block)).cast("long").alias("blocks"),
        F.when(live, F.round(F.pow(tokens, F.lit(x)) / F.lit(z), 6)).otherwise(0.0).alias("weight"),
        F.when(live, quota).otherwise(0).cast("long").alias("quota"),
    )
    sums = cut(sums.withColumn("whole", F.when(live, F.expr("quota div tokens")).otherwise(1)).withColumn("part", F.when(live, F.expr("quota % tokens")).otherwise(0)))

    own = _with_source(light.select("id", "source", F.col("tokens").alias("own")), sums.select("source", "blocks", "whole", "part").where("part > 0"))
    own = own.withColumn("block", _block(seed, "id", "blocks"))
    totals = own.groupBy("source", "block", "whole", "part").agg(F.sum("own").alias("total"))
    totals = totals.withColumn("key", _block_key(seed, "source", "whole", "block"))
    order = Window.partitionBy("source").orderBy("key", "block")
    edges = totals.withColumn("upto", F.sum("total").over(order.rowsBetween(Window.unboundedPreceding, 0))).where("upto > part").groupBy("source").agg(F.min(F.struct("key", "block", (F.col("upto") - F.col("total")).alias("base"))).alias("edge"))
    edges = cut(edges.select("source", F.col("edge.key").alias("edge_key"), F.col("edge.block").alias("edge_block"), F.col("edge.base").alias("base")))

    inside = _with_source(own, edges).where("block = edge_block").withColumn("key", _doc_key(seed, "whole", "id"))
    upto = F.col("base") + F.sum("own").over(Window.partitionBy("source").orderBy("key", "id"))
    last = inside.withColumn("upto", upto).where("upto <= part").groupBy("source").agg(F.max(F.struct("key", F.coalesce("id", F.lit(-(1 << 63))).alias("id"))).alias("last"))
    last = last.select("source", F.col("last.key").alias("cut_key"), F.col("last.id").alias("cut_id"))
    return cut(_by_source(_by_source(sums, edges.drop("base")), last).select("source", "tokens", "weight", "blocks", "whole", "edge_key", "edge_block", "cut_key", "cut_id"))


def _by_source(left: DataFrame, right: DataFrame) -> DataFrame:
    other = right.withColumnRenamed("source", "_source")
    return left.join(other, left["source"].eqNullSafe(other["_source"]), "left").drop("_source")


def _with_source(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Inner join with a table that has one row a source; broadcast where that is small, by count."""
    other = sources.withColumnRenamed("source", "_source")
    if sources.count() <= BROADCAST_SOURCES:
        other = F.broadcast(other)
    return rows.join(other, rows["source"].eqNullSafe(other["_source"])).drop("_source")


def _epochs(seed: int) -> Column:
    """Epochs in which a row with its source's plan is read."""
    inside = (
        "case when edge_key is null then false"
        " when {bk} < edge_key then true"
        " when block = edge_block then coalesce(struct({dk}, coalesce(id, -9223372036854775808L)) <= struct(cut_key, cut_id), false)"
        " else false end"
    )
    bk = f"md5(concat_ws(':', '{seed}', 'order', source, whole, block))"
    dk = f"md5(concat_ws(':', '{seed}', 'doc', whole, id))"
    return F.expr(f"if({inside.format(bk=bk, dk=dk)}, sequence(0L, whole), if(whole > 0, sequence(0L, whole - 1), cast(array() as array<bigint>)))")


def mixture(docs: DataFrame, entropy: float = ENTROPY, max_epochs: float = MAX_EPOCHS, budget: int | None = None, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """(doc_id, source, tokens, epoch, block, weight): one row for each reading of each row of `docs`.

    Tokens are words. A null source is a source of its own; a source without
    tokens is read once. Rows with the same doc_id stand and fall together
    where a partial epoch ends. Reading order in an epoch: `stream_order`.
    An empty table gives no rows.
    """
    prepare(docs.sparkSession)
    light = cut(docs.select(F.col("doc_id").cast("long").alias("id"), F.col("source").cast("string").alias("source"), word_count(F.col("text").cast("string")).alias("own")))
    made = plan(light.withColumnRenamed("own", "tokens"), entropy, max_epochs, budget, block, seed)
    rows = _with_source(light, made.drop("tokens")).withColumn("block", _block(seed, "id", "blocks"))
    read = rows.withColumn("epoch", F.explode(_epochs(seed)))
    return read.select(F.col("id").alias("doc_id"), "source", F.col("own").alias("tokens"), F.col("epoch").cast("int").alias("epoch"), "block", "weight")


def stream_order(seed: int = SEED) -> list[Column]:
    """Sort keys of the reading order of a source's rows of `mixture`."""
    return [F.col("epoch"), _block_key(seed, "source", "epoch", "block"), _doc_key(seed, "epoch", "doc_id"), F.col("doc_id")]


def mix_sources(docs: DataFrame, entropy: float = ENTROPY, max_epochs: float = MAX_EPOCHS, budget: int | None = None, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """`docs` with each row as often as it is read, all its columns as they are; texts aren't shuffled."""
    prepare(docs.sparkSession)
    light = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("source").cast("string").alias("source"), word_count(F.col("text").cast("string")).alias("tokens"))
    made = plan(cut(light), entropy, max_epochs, budget, block, seed)
    held = fresh(docs, "row")
    rows = docs.select(F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias(held), F.col("doc_id").cast("long").alias("id"), F.col("source").cast("string").alias("source"))
    rows = _with_source(rows, made.drop("tokens")).withColumn("block", _block(seed, "id", "blocks"))
    return rows.withColumn("_epoch", F.explode(_epochs(seed))).select(f"{quoted(held)}.*")
