"""Near-duplicate vectors by random-hyperplane sign hashing, exact cosines, and connected components.

1. Equal vectors form a class; its least vec_id stands for it with its count.
2. Each class gets one sign per hyperplane: `tables` groups of `bits` signs.
   Classes that agree in a whole group share a bucket of that table. Bits grow
   with log2 of the number of classes so that a bucket of unrelated vectors
   stays small, and tables with them so that a pair at the threshold misses all
   tables with probability MISS.
3. Buckets are cut into blocks that meet two by two. In a first pass a vector
   sends, for each table, its id and two words of further signs: only vectors
   go on that have a partner in their unit whose words differ in few enough
   places.
4. The second pass brings those vectors and takes exact cosines in double
   precision, of each pair in the first table in which it meets. A unit returns
   counts of links and a spanning forest of them, never its pairs, so dense
   groups return rows in proportion to their vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritab.llm.common import block_units, cut, prepare, sliced, units_of
from veritab.llm.components import connected_components

#: Probability that a pair exactly at the threshold shares no bucket.
MISS = 1e-4
#: Vectors that a bucket of unrelated vectors holds on average, rows a side of a unit, and rows compared at once.
BUCKET, BLOCK, TILE = 256, 8192, 1024
#: Signs in the two words of the first pass.
WORDS = 128
SEED = 97


def tables_for(classes: int, cosine: float, miss: float = MISS) -> tuple[int, int]:
    """(bits, tables) for a number of distinct vectors."""
    bits = min(30, max(6, math.ceil(math.log2(max(classes, 1) / BUCKET + 1))))
    same = (1 - math.acos(min(1.0, max(-1.0, cosine))) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(miss) / math.log1p(-min(same, 1 - 1e-9))))


def most_apart(planes: int, cosine: float) -> int:
    """Differing signs beyond which a pair isn't compared: six standard deviations above the mean at the threshold."""
    p = math.acos(min(1.0, max(-1.0, cosine))) / math.pi
    return math.ceil(planes * p + 6 * math.sqrt(planes * p * (1 - p)))


def _hyperplanes(dim: int, planes: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64([SEED, dim])).standard_normal((dim, planes))


def _clean(vectors: list) -> list[np.ndarray | None]:
    """Double vectors; None where null, empty, zero, or with null or non-finite components."""
    out: list[np.ndarray | None] = []
    for v in vectors:
        x = None if v is None or len(v) == 0 or any(c is None for c in v) else np.asarray(v, dtype=np.float64)
        out.append(x if x is not None and np.isfinite(x).all() and x.any() else None)
    return out


def _read(kind: str):
    """(vec_id, key, vector): vectors travel as they came, single floats as such, and are widened where they are used."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            clean = _clean(batch.column(1).to_pylist())
            raw = [None if x is None else x.astype(kind).tobytes() for x in clean]
            keys = [None if r is None else xxhash.xxh3_128_digest(r) for r in raw]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary()), pa.array(raw, pa.binary())], ["vec_id", "key", "vector"])

    return run


def _wide(raw: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(raw, kind).astype(np.float64)


def _buckets(x: np.ndarray, planes: np.ndarray, bits: int, tables: int) -> np.ndarray:
    signs = x / np.abs(x).max() @ planes[:, : bits * tables] >= 0
    return ((len(x) * tables + np.arange(tables)) << 30) | (signs.reshape(tables, bits) @ (1 << np.arange(bits, dtype=np.int64)))


def _sign(bits: int, tables: int, kind: str):
    """(id, buckets, s1, s2): a bucket of each table, and the signs of WORDS more hyperplanes."""
    planes: dict[int, np.ndarray] = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            words, buckets = [], []
            for raw in batch.column(1).to_pylist():
                x = _wide(raw, kind)
                if len(x) not in planes:
                    planes[len(x)] = _hyperplanes(len(x), bits * tables + WORDS)
                own = planes[len(x)]
                words.append(np.packbits(x / np.abs(x).max() @ own[:, bits * tables :] >= 0).tobytes())
                buckets.append(_buckets(x, own, bits, tables))
            w = np.frombuffer(b"".join(words), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(buckets, pa.list_(pa.int64())), pa.array(w[:, 0].copy()), pa.array(w[:, 1].copy())], ["id", "buckets", "s1", "s2"])

    return run


def _partnered(apart: int):
    """Rows (unit, bucket, id, side, s1, s2) that have a partner in their unit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in units_of(batches):
            side = rows.column("side").to_numpy()
            s1, s2 = (rows.column(c).to_numpy().view(np.uint64) for c in ("s1", "s2"))
            split = (side != side[0]).any()
            some = np.zeros(len(side), dtype=bool)
            for p in range(0, len(side), TILE):
                x, y = slice(p, p + TILE), slice(p, None)
                near = np.triu(np.bitwise_count(s1[x, None] ^ s1[None, y]) + np.bitwise_count(s2[x, None] ^ s2[None, y]) <= apart, 1)
                if split:  # two blocks: pairs inside one block meet in its own unit
                    near &= side[x, None] != side[None, y]
                some[x] |= near.any(axis=1)
                some[y] |= near.any(axis=0)
            if some.any():
                yield from rows.filter(pa.array(some)).select(["unit", "bucket", "id", "side"]).to_batches()

    return run


def _linked(tables: int, cosine: float, kind: str):
    """Counts and a forest of the links of each unit of rows (unit, bucket, id, side, copies, vector, buckets)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in units_of(batches):
            x = np.stack([_wide(v, kind) for v in rows.column("vector").to_pylist()])
            x = x / np.abs(x).max(axis=1, keepdims=True)
            x = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
            ids, copies, side = (rows.column(c).to_numpy() for c in ("id", "copies", "side"))
            split = (side != side[0]).any()
            own = np.stack(rows.column("buckets").to_numpy())
            table = (rows.column("bucket")[0].as_py() >> 30) % tables
            n, us, vs = np.zeros(len(ids), np.int64), [], []
            for p in range(0, len(ids), TILE):
                for q in range(p, len(ids), TILE):
                    a, b = slice(p, p + TILE), slice(q, q + TILE)
                    link = x[a] @ x[b].T >= cosine
                    link = np.triu(link, 1) if p == q else link
                    if split:
                        link &= side[a, None] != side[None, b]
                    i, j = np.nonzero(link)
                    i, j = i + p, j + q
                    for t in range(table):  # pairs that met in an earlier table are counted there
                        fresh = own[i, t] != own[j, t]
                        i, j = i[fresh], j[fresh]
                    np.add.at(n, i, copies[j])
                    np.add.at(n, j, copies[i])
                    u, v = _forest(i, j)
                    us.append(u)
                    vs.append(v)
            u, v = _forest(np.concatenate(us), np.concatenate(vs))
            some = np.flatnonzero(n)
            for k in range(0, len(some), 1 << 16):
                at = some[k : k + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.nulls(len(at), pa.int64()), pa.array(n[at])], ["u", "v", "n"])
            for k in range(0, len(u), 1 << 16):
                at = slice(k, k + (1 << 16))
                yield pa.RecordBatch.from_arrays([pa.array(ids[u[at]]), pa.array(ids[v[at]]), pa.array(np.zeros(len(u[at]), np.int64))], ["u", "v", "n"])

    return run


def _forest(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the pairs (i, j)."""
    root: dict[int, int] = {}
    u, v = [], []

    def find(x: int) -> int:
        top = x
        while root.setdefault(top, top) != top:
            top = root[top]
        while root[x] != top:
            root[x], x = top, root[x]
        return top

    for a, b in zip(i.tolist(), j.tolist()):
        p, q = find(a), find(b)
        if p != q:
            root[q] = p
            u.append(a)
            v.append(b)
    return np.array(u, dtype=np.int64), np.array(v, dtype=np.int64)


def near_vectors(vectors: DataFrame, cosine: float = 0.95, miss: float = MISS) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of `vectors` (vec_id, embedding).

    Rows link where their cosine in double precision is at least `cosine`.
    n_links counts the other rows linked directly, component_id is the least
    vec_id reachable. Vectors that are null, empty, zero, or hold null or
    non-finite components link with nothing, nor do vectors of different
    length. A row without a vec_id links with nothing: component_id is null and
    it is kept. Rows that share a vec_id share their component. An empty table
    gives no rows.
    """
    prepare(vectors.sparkSession)
    kind = "<f4" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "<f8"
    made = cut(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(_read(kind), "vec_id long, key binary, vector binary"))
    usable = made.where("key is not null and vec_id is not null")
    classes = cut(usable.groupBy("key").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("vector").alias("vector")).select("rep", "copies", "vector", "key"))
    bits, tables = tables_for(classes.count(), cosine, miss)
    apart = most_apart(WORDS, cosine)
    body = classes.withColumn("id", F.xxhash64("key"))

    signed = body.select("id", "vector").mapInArrow(_sign(bits, tables, kind), "id long, buckets array<long>, s1 long, s2 long")
    signed = cut(signed)
    rows = signed.select("id", F.explode("buckets").alias("bucket"), "s1", "s2")
    units = block_units(rows, ["bucket"], "id", BLOCK).select("unit", "bucket", "id", "side", "s1", "s2")
    partnered = cut(units.repartition("unit").sortWithinPartitions("unit").mapInArrow(_partnered(apart), "unit long, bucket long, id long, side long"))
    full = partnered.join(body.select("id", "copies", "vector"), "id").join(signed.select("id", "buckets"), "id").select("unit", "bucket", "id", "side", "copies", "vector", "buckets")
    found = cut(full.repartition("unit").sortWithinPartitions("unit").mapInArrow(_linked(tables, cosine, kind), "u long, v long, n long"))

    reps = body.select("id", "rep")
    links = found.where("v is not null").select("u", "v")
    links = links.join(reps.toDF("u", "a"), "u").join(reps.toDF("v", "b"), "v").select(F.col("a").alias("u"), F.col("b").alias("v"))
    member = usable.select("vec_id", "key").join(body.select("key", "id", "rep", "copies"), "key")
    copies = member.where("vec_id <> rep").select(F.col("rep").alias("u"), F.col("vec_id").alias("v"))
    whole = connected_components(links.unionByName(copies))
    counts = found.where("v is null").groupBy(F.col("u").alias("id")).agg(F.sum("n").alias("n"))
    per_class = body.select("key", "id", "copies").join(counts, "id", "left").select("key", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = made.withColumn("live", F.when(F.col("vec_id").isNotNull(), F.col("key"))).select("vec_id", "live")
    out = out.join(per_class, out["live"] == per_class["key"], "left")
    return out.join(whole, out["vec_id"] == whole["node"], "left").select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"), F.coalesce(F.col("component") == F.col("vec_id"), F.lit(True)).alias("kept"))
