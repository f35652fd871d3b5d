"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

A document is the set of its distinct five-word shingles. Each set gets a fast
similarity sketch (rounds of hashed bin placement, the second half of which
fill every coordinate), the sketch is cut into bands, and documents that share
a band are candidates. Every link is confirmed on the full sets.

Plan, for any size of input:

1. One scan makes set size, set identity, sketch and band keys of every text.
2. Documents with the same set form a class; only its least doc_id goes on, so
   a group of exact copies of any size costs one sketch.
3. Round one compares the members of a bucket with its least member (linear in
   the bucket). Confirmed links give components.
4. Round two compares, in buckets that still hold several components, the pairs
   across components, in blocks of at most BLOCK rows a side, by their
   sketches; only pairs whose sketches agree well enough (DEVIATIONS) are sent
   to verification. A pair inside one component can't change it, so the
   result is that of all pairs.

Full sets are rebuilt only for documents in candidate pairs. They are picked in
the scan by a Bloom filter whose size follows the number of pairs, so texts
aren't shuffled; where there are more ids than a filter of ID_FILTER_BITS can
tell apart, ids and texts are joined by shuffle instead, with the same result.
For verification a member's set meets its head's once for each block of
members, so a head with millions of members isn't copied into as many rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritab.llm.common import ID_BITS, ID_FILTER_BITS, IdFilter, block_units, cut, doc_texts, fresh, hot_groups, prepare, quoted, raw_texts, sliced, units_of, without_ids
from veritab.llm.components import connected_components
from veritab.llm.hashing import ascii_words, band_keys, fast_sketch, set_identity, shingle_set

#: Probability that a pair exactly at the threshold shares no band, and coordinates of a sketch at most.
MISS, COORDINATES = 2e-5, 150
#: Standard deviations of the share of equal coordinates below the threshold, under which a pair isn't verified.
DEVIATIONS = 5
#: Rows of a bucket, and members of a head, that one unit of work takes; sketches are compared TILE by TILE.
BLOCK, TILE = 8192, 256
#: Shingles sketched at once in a Python worker (8 bytes each, a few copies).
CHUNK = 400_000

_SCHEMA = "doc_id long, n_shingles long, h1 long, h2 long, bands array<long>, sketch binary"


def banding(percent: int) -> tuple[int, int]:
    """(bands, rows): the longest bands that keep misses at the threshold under MISS within COORDINATES. 23 x 6 at 85, 28 x 5 at 80."""
    j = min(max(percent, 1), 99) / 100
    for rows in range(12, 0, -1):
        bands = math.ceil(math.log(MISS) / math.log1p(-(j**rows)))
        if bands * rows <= COORDINATES:
            return bands, rows
    return bands, 1  # low thresholds take as many coordinates as MISS asks for


def least_agreement(percent: int, coordinates: int) -> float:
    """Share of equal coordinates from which a pair is verified."""
    j = min(percent, 100) / 100
    return j - DEVIATIONS * math.sqrt(j * (1 - j) / coordinates)


def _sketch_rows(width: int, bands: int, rows: int):
    t = bands * rows

    def flush(ids: list, sets: list[np.ndarray]) -> pa.RecordBatch:
        sizes = np.array([len(s) for s in sets], dtype=np.int64)
        full = np.flatnonzero(sizes)
        h1, h2 = np.zeros(len(sets), np.uint64), np.zeros(len(sets), np.uint64)
        keys: list = [None] * len(sets)
        sketches: list = [None] * len(sets)
        if len(full):
            elements, own = np.concatenate([sets[i] for i in full]), sizes[full]
            starts = np.concatenate([[0], np.cumsum(own)[:-1]])
            h1[full], h2[full] = set_identity(elements, starts)
            sk = fast_sketch(elements, own, t)
            bk = band_keys(sk, bands, rows)
            short = sk.astype(np.uint16)  # low bits: enough to count equal coordinates
            for k, i in enumerate(full):
                keys[i], sketches[i] = bk[k], short[k].tobytes()
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(sizes), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), pa.array(keys, pa.list_(pa.int64())), pa.array(sketches, pa.binary())],
            ["doc_id", "n_shingles", "h1", "h2", "bands", "sketch"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            ids, sets, held = [], [], 0
            for doc_id, raw in zip(batch.column(0).to_pylist(), raw_texts(batch, 1)):
                s = shingle_set(ascii_words(raw), width)
                ids.append(doc_id)
                sets.append(s)
                held += len(s)
                if held >= CHUNK:
                    yield flush(ids, sets)
                    ids, sets, held = [], [], 0
            if ids:
                yield flush(ids, sets)

    return run


def sketches(docs: DataFrame, width: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, n_shingles, h1, h2, bands, sketch) of every row; empty sets have null bands and sketch."""
    return doc_texts(docs).mapInArrow(_sketch_rows(width, bands, rows), _SCHEMA)


def _sets_of(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """(id, set) of at least the documents in `ids` (one column, distinct, checkpointed)."""
    texts = doc_texts(docs).where("doc_id is not null")
    count = ids.count()
    words = None
    if count * ID_BITS <= 2 * ID_FILTER_BITS:
        words = docs.sparkSession.sparkContext.broadcast(IdFilter.build(ids, count).words)
    else:
        texts = texts.join(ids.toDF("doc_id"), "doc_id", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = None if words is None else IdFilter(words.value)
        for batch in sliced(batches):
            part = batch if keep is None else batch.take(pa.array(np.flatnonzero(keep.may_hold(batch.column(0).to_numpy(zero_copy_only=False)))))
            if part.num_rows:
                sets = [shingle_set(ascii_words(raw), width).tobytes() for raw in raw_texts(part, 1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.large_binary()).cast(pa.binary())], ["id", "set"])

    return texts.mapInArrow(run, "id long, set binary")


def _confirm(percent: int):
    """Links (u, v) from rows (a, block, b, set) in which a head, with no `b`, comes before the members of its block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, heads = None, []
        for batch in sliced(batches):
            u, v = [], []
            for a, block, b, raw in zip(*(batch.column(k).to_pylist() for k in range(4))):
                own = np.frombuffer(raw, np.uint64)
                if (a, block) != at:
                    at, heads = (a, block), []
                if b is None:
                    heads.append(own)  # rows that share an id may have several sets
                elif any(_reaches(x, own, percent) for x in heads):
                    u.append(a)
                    v.append(b)
            if u:
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    return run


def _reaches(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    if percent * max(len(x), len(y)) > 100 * min(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def _verified(docs: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach `percent`; checkpointed."""
    pairs = cut(pairs)
    sets = cut(_sets_of(docs, cut(pairs.select("a").union(pairs.select("b")).toDF("id").distinct()), width))
    hot = hot_groups(pairs, ["a"], BLOCK).select("a", F.ceil(F.col("n") / F.lit(BLOCK)).alias("blocks"))
    placed = pairs.join(F.broadcast(hot), "a", "left").select("a", F.pmod(F.xxhash64("b"), F.coalesce("blocks", F.lit(1))).alias("block"), "b")
    heads = placed.select("a", "block").distinct().join(sets.toDF("a", "set"), "a").select("a", "block", F.lit(None).cast("long").alias("b"), "set")
    members = placed.join(sets.toDF("b", "set"), "b").select("a", "block", "b", "set")
    together = heads.unionByName(members).repartition("a", "block").sortWithinPartitions("a", "block", F.col("b").asc_nulls_first())
    return cut(together.mapInArrow(_confirm(percent), "u long, v long"))


def _pairs_across(floor: float, percent: int):
    """Candidate pairs between components within units of rows sorted by unit: (unit, id, comp, n, side, sketch)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in units_of(batches):
            ids, comp, n, side = (rows.column(k).to_numpy() for k in range(1, 5))
            if (comp == comp[0]).all():
                continue
            sk = np.frombuffer(b"".join(rows.column(5).to_pylist()), np.uint16).reshape(len(ids), -1)
            split = (side != side[0]).any()
            for p in range(0, len(ids), TILE):
                x = slice(p, p + TILE)
                y = slice(p, None)  # pairs of earlier rows came in earlier tiles
                good = (comp[x, None] != comp[None, y]) & (100 * np.minimum(n[x, None], n[None, y]) >= percent * np.maximum(n[x, None], n[None, y]))
                if split:
                    good &= side[x, None] != side[None, y]
                i, j = np.nonzero(np.triu(good, 1))
                for k in range(0, len(i), 1 << 16):
                    a, b = i[k : k + (1 << 16)] + p, j[k : k + (1 << 16)] + p
                    near = (sk[a] == sk[b]).sum(axis=1) >= floor * sk.shape[1]
                    if near.any():
                        a, b = ids[a[near]], ids[b[near]]
                        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    return run


def near_duplicates(docs: DataFrame, percent: int = 80, width: int = 5) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of `docs` (doc_id, text).

    Documents are linked where 100 x intersection >= percent x union of their
    shingle sets; component_id is the least doc_id reachable by links and kept
    marks that document. Null and empty texts, and texts without words, have
    no shingles and link with nothing. Rows that share a doc_id count as one
    document and all carry its result. A null doc_id links with nothing: its
    component_id is null and it is kept. An empty table gives no rows.
    """
    prepare(docs.sparkSession)
    bands, rows = banding(percent)
    floor = least_agreement(percent, bands * rows)
    made = cut(sketches(docs, width, bands, rows))
    usable = made.where("doc_id is not null and n_shingles > 0")
    classes = usable.groupBy("n_shingles", "h1", "h2").agg(F.min("doc_id").alias("rep"))
    member = usable.select("doc_id", "n_shingles", "h1", "h2").distinct().join(classes, ["n_shingles", "h1", "h2"])
    same = member.where("doc_id <> rep").select(F.col("rep").alias("u"), F.col("doc_id").alias("v"))

    reps = usable.join(classes, ["n_shingles", "h1", "h2"]).where("doc_id = rep").dropDuplicates(["doc_id", "h1", "h2"])
    banded = reps.select(F.col("doc_id").alias("id"), F.explode("bands").alias("band"))
    heads = banded.groupBy("band").agg(F.min("id").alias("head"), F.count("*").alias("n")).where("n > 1").select("band", "head")
    shared = cut(banded.join(heads, "band"))

    size = reps.select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"))
    star = shared.where("id <> head").select(F.col("head").alias("a"), F.col("id").alias("b")).distinct()
    near_size = F.expr(f"100 * least(na, nb) >= {int(percent)} * greatest(na, nb)")
    star = star.join(size.toDF("a", "na"), "a").join(size.toDF("b", "nb"), "b").where(near_size).select("a", "b").distinct()
    first = _verified(docs, star, width, percent)
    comp = cut(connected_components(first))

    label = F.coalesce("component", "id").alias("comp")
    where = shared.select("band", "id").join(comp.withColumnRenamed("node", "id"), "id", "left").select("band", "id", label)
    mixed = where.groupBy("band").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("band")
    open_rows = cut(where.join(mixed, "band"))
    body = reps.select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), "sketch")
    units = block_units(open_rows, ["band"], "id", BLOCK).select("unit", "id", "comp", "side").join(body, "id")
    across = units.select("unit", "id", "comp", "n", "side", "sketch").repartition("unit").sortWithinPartitions("unit").mapInArrow(_pairs_across(floor, percent), "a long, b long").distinct()
    second = _verified(docs, across, width, percent)

    whole = connected_components(first.unionByName(second).unionByName(same))
    return made.join(whole, made["doc_id"] == whole["node"], "left").select(made["doc_id"], "n_shingles", F.coalesce("component", made["doc_id"]).alias("component_id"), F.coalesce(F.col("component") == made["doc_id"], F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """`docs` with one document of each group of near duplicates, all its columns as they are.

    Of rows that share a doc_id one stays: that with the least text (null
    first; of equal texts any one). Rows with a null doc_id all stay.
    """
    gone = cut(near_duplicates(docs, percent).where("not kept").select("doc_id").distinct())
    left = without_ids(docs, gone)
    twice = cut(docs.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).count().where("count > 1").select("doc_id"))
    if twice.isEmpty():
        return left
    again, row = fresh(docs, "again"), fresh(docs, "row")
    held = left.join(twice.toDF(again), left["doc_id"].cast("long") == F.col(again), "left_semi")
    text = F.col("text").cast("string")
    one = held.groupBy(F.col("doc_id").cast("long").alias(again)).agg(F.min_by(F.struct(*[F.col(quoted(c)) for c in docs.columns]), F.struct(text.isNotNull().alias("has"), text.alias("text"))).alias(row))
    return without_ids(left, twice).unionByName(one.select(f"{row}.*"))
