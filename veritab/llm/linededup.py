"""Line dedup with two Bloom filters, one for keys seen once and one for keys seen twice.

A line's key is the line stripped of [\\x20\\x09-\\x0D] at both ends, A-Z
lower-cased. Keys of at least `min_chars` code points found in at least
`min_docs` documents lose their lines in all documents but that with the
largest doc_id that holds them.

1. One scan makes the distinct key digests of every row; from there on only
   digests are read, with the row's id and a hash of its text.
2. The filters are sized from the approximate number of distinct keys. Each
   task sets bits for its keys: the first time in "once", again in "twice".
   Chunks of bits are merged by chunk number (once = OR, twice = OR of the
   twices and of what two onces share). Only the digests that "twice" may hold
   are shuffled; counting them exactly (combined in the map tasks) confirms
   repeats.
3. With more keys than one filter of BITS can tell apart, keys are cut into
   ranges of about RANGE_KEYS. A task's keys, combined to (key, rows, largest
   id), go once to the task of their range, which keeps the two filters of
   that range; only what its "twice" may hold is counted exactly. The share of
   suspects is therefore the same for any number of keys.
4. Keys with more than a hundred-thousandth of all suspected rows are joined
   by broadcast (at most a hundred thousand such keys can be), others by
   shuffle. Decisions are gathered by row: a row's lost keys are fewer than its
   own lines.
5. Rows in the decisions, picked by a Bloom filter sized from their number,
   meet their dropped keys; all others are finished in the scan and aren't
   shuffled.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritab.llm.common import HOT_SHARE, IdFilter, cut, doc_texts, filter_bits, gathered, prepare, raw_texts, sliced

#: Bits of one filter at most (32 MB in a task and when broadcast), in chunks of CHUNK_BITS, and for each key.
BITS, CHUNK_BITS, KEY_BITS = 1 << 28, 1 << 19, 8
#: Keys of a range, where one filter can't hold all.
RANGE_KEYS = 1 << 20
#: Rows from which a key may be hot.
HOT = 10_000
_BLANK = b" \t\n\x0b\x0c\r"
_NONE = -(1 << 63)


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """The key of a line, or None where it has fewer than `min_chars` code points."""
    key = line.strip(_BLANK)
    if len(key) < min_chars:
        return None
    if len(key) < 4 * min_chars and sum((b & 0xC0) != 0x80 for b in key) < min_chars:
        return None
    return key.lower()


def _digests(raw: bytes | None, min_chars: int) -> set[bytes]:
    keys = {line_key(line, min_chars) for line in (raw or b"").split(b"\n")}
    keys.discard(None)
    return {xxhash.xxh3_128_digest(k) for k in keys}


def short(digest: bytes) -> int:
    """The half of a digest by which a row's own keys are told apart."""
    return int.from_bytes(digest[:8], "little", signed=True)


def _row_keys(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            keys, sizes = [], []
            for raw in raw_texts(batch, 1):
                own = _digests(raw, min_chars)
                keys.extend(own)
                sizes.append(len(own))
            if keys:
                k = np.frombuffer(b"".join(keys), "<i8").reshape(-1, 2)
                row = pa.array(np.repeat(np.arange(len(sizes)), sizes))
                yield pa.RecordBatch.from_arrays([pa.array(k[:, 0].copy()), pa.array(k[:, 1].copy()), batch.column(0).take(row), batch.column(2).take(row)], ["k1", "k2", "id", "mark"])

    return run


def _marked(docs: DataFrame) -> DataFrame:
    """(id, text, mark) of documents: null ids are the smallest, mark is a hash of the text."""
    return doc_texts(docs).select(F.coalesce("doc_id", F.lit(_NONE)).alias("id"), "text", F.xxhash64("text").alias("mark"))


def _positions(k1: np.ndarray, k2: np.ndarray, bits: int) -> np.ndarray:
    """Two bit positions of each key."""
    return np.stack([k1 & (bits - 1), k2 & (bits - 1)], axis=1)


def _distinct(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """k1, k2 and number of rows of each key; keys that share k1 count as one, which can only make more suspects."""
    k1, k2 = rows.column(0).to_numpy(), rows.column(1).to_numpy()
    own, at, n = np.unique(k1, return_index=True, return_counts=True)
    return own, k2[at], n


class _Chunks:
    """Sparse bit chunks: memory follows the bits that are set, up to the filter's size."""

    def __init__(self, bits: int, chunk: int):
        self.bits, self.chunk, self.held = bits, chunk, {}

    def get(self, p: np.ndarray) -> np.ndarray:
        out = np.zeros(len(p), dtype=bool)
        for c, at in self._split(p):
            if c in self.held:
                q = p[at] % self.chunk
                out[at] = (self.held[c][q >> 3] >> (q & 7)) & 1
        return out

    def set(self, p: np.ndarray) -> None:
        for c, at in self._split(p):
            q = p[at] % self.chunk
            own = self.held.setdefault(c, np.zeros(self.chunk // 8, dtype=np.uint8))
            np.bitwise_or.at(own, q >> 3, (1 << (q & 7)).astype(np.uint8))

    def _split(self, p: np.ndarray):
        c = p // self.chunk
        order = np.argsort(c, kind="stable")
        edges = np.flatnonzero(np.diff(c[order])) + 1
        for at in np.split(order, edges) if len(order) else []:
            yield int(c[at[0]]), at


def _seen_filters(bits: int, chunk: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = _Chunks(bits, chunk), _Chunks(bits, chunk)
        for rows in gathered(batches):
            k1, k2, n = _distinct(rows)
            p = _positions(k1, k2, bits)
            again = (n > 1) | (once.get(p[:, 0]) & once.get(p[:, 1]))
            twice.set(p[again].ravel())
            once.set(p.ravel())
        for c in sorted(once.held):
            two = twice.held.get(c)
            yield pa.RecordBatch.from_arrays(
                [pa.array([c], pa.int64()), pa.array([zlib.compress(once.held[c].tobytes(), 1)], pa.binary()), pa.array([None if two is None else zlib.compress(two.tobytes(), 1)], pa.binary())],
                ["chunk", "once", "twice"],
            )

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Twice-seen bits of each chunk, from rows sorted by chunk."""
    at = once = twice = None

    def row():
        return pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([zlib.compress(twice.tobytes(), 1)], pa.binary())], ["chunk", "bits"])

    for batch in batches:
        for c, a, b in zip(*(batch.column(k).to_pylist() for k in range(3))):
            a = np.frombuffer(zlib.decompress(a), np.uint8)
            if c != at:
                if at is not None and twice.any():
                    yield row()
                at, once, twice = c, np.zeros_like(a), np.zeros_like(a)
            twice = twice | (once & a)
            if b is not None:
                twice = twice | np.frombuffer(zlib.decompress(b), np.uint8)
            once = once | a
    if at is not None and twice.any():
        yield row()


def _suspects(filters, bits: int, chunk: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice = _Chunks(bits, chunk)
        twice.held = {c: np.frombuffer(zlib.decompress(z), np.uint8) for c, z in filters.value.items()}
        for rows in gathered(batches):
            p = _positions(rows.column(0).to_numpy(), rows.column(1).to_numpy(), bits)
            yield from rows.filter(pa.array(twice.get(p[:, 0]) & twice.get(p[:, 1]))).to_batches()

    return run


def _combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(k1, k2, n, last) of the keys of a task, combined over as many rows as a range has keys."""
    for rows in gathered(batches, RANGE_KEYS):
        k1, k2, ids = (rows.column(k).to_numpy() for k in range(3))
        order = np.lexsort((k2, k1))
        k1, k2 = k1[order], k2[order]
        first = np.flatnonzero(np.concatenate([[True], (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])]))
        n = np.diff(np.concatenate([first, [len(k1)]]))
        yield pa.RecordBatch.from_arrays([pa.array(k1[first]), pa.array(k2[first]), pa.array(n), pa.array(np.maximum.reduceat(ids[order], first))], ["k1", "k2", "n", "last"])


def _range_suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (k1, k2, n, last) of one range of keys whose key may stand for several documents, by the two filters of the range."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    rows = pa.Table.from_batches(held)
    bits = filter_bits(rows.num_rows, KEY_BITS, BITS)
    once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
    k1, k2, n = (rows.column(k).to_numpy() for k in range(3))

    def may_hold(bitmap: np.ndarray, p: np.ndarray) -> np.ndarray:
        got = (bitmap[p >> 3] >> (p & 7).astype(np.uint8)) & 1
        return (got[:, 0] & got[:, 1]).astype(bool)

    def mark(bitmap: np.ndarray, p: np.ndarray) -> None:
        np.bitwise_or.at(bitmap, p.ravel() >> 3, (1 << (p.ravel() & 7)).astype(np.uint8))

    for k in range(0, rows.num_rows, 1 << 14):
        part = slice(k, k + (1 << 14))
        p = _positions(k1[part], k2[part], bits)
        _, inverse, times = np.unique(k1[part], return_inverse=True, return_counts=True)
        mark(twice, p[(n[part] > 1) | (times[inverse] > 1) | may_hold(once, p)])
        mark(once, p)
    yield from rows.filter(pa.array(may_hold(twice, _positions(k1, k2, bits)))).to_batches()


def suspected(rows: DataFrame, keys: int, bits: int = BITS) -> tuple[DataFrame, DataFrame]:
    """(rows to join, counts): `rows` (checkpointed) without what no filter suspects, and (k1, k2, n, last) of the suspected keys.

    `keys` is about how many keys there are. With ranges, all rows stay to be
    joined: a range's filter is known to its own task only.
    """
    if keys * KEY_BITS <= bits:
        own = filter_bits(keys, KEY_BITS, bits)
        chunk = min(own, CHUNK_BITS)
        parts = rows.select("k1", "k2").mapInArrow(_seen_filters(own, chunk), "chunk long, once binary, twice binary")
        merged = parts.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(_merge, "chunk long, bits binary").collect()  # at most 2 x own / 8 bytes
        filters = rows.sparkSession.sparkContext.broadcast({r["chunk"]: bytes(r["bits"]) for r in merged})
        seen = cut(rows.mapInArrow(_suspects(filters, own, chunk), rows.schema))
        return seen, seen.groupBy("k1", "k2").agg(F.count("*").alias("n"), F.max("id").alias("last"))
    ranges = math.ceil(keys / min(RANGE_KEYS, max(1, bits // KEY_BITS)))
    shape = "k1 long, k2 long, n long, last long"
    few = rows.select("k1", "k2", "id").mapInArrow(_combined, shape).repartition(ranges, "k1").mapInArrow(_range_suspects, shape)
    return rows, few.groupBy("k1", "k2").agg(F.sum("n").alias("n"), F.max("last").alias("last"))


def repeated_lines(docs: DataFrame, min_docs: int = 3, min_chars: int = 20, bits: int = BITS) -> DataFrame:
    """(id, mark, keys): short digests of the keys whose lines the rows with doc_id `id` and text hash `mark` lose; checkpointed.

    Documents are rows: repeated rows each count. A null doc_id counts as the
    smallest (-2^63 in `id`).
    """
    prepare(docs.sparkSession)
    rows = cut(_marked(docs).mapInArrow(_row_keys(min_chars), "k1 long, k2 long, id long, mark long"))
    keys = rows.agg(F.approx_count_distinct("k1", 0.02)).first()[0]
    seen, counts = suspected(rows, int(keys), bits)
    found = cut(counts.where(F.col("n") >= min_docs))
    hot = F.broadcast(found.where((F.col("n") > HOT) & (F.col("n") * HOT_SHARE > seen.count())).select("k1", "k2", "last"))  # fewer than HOT_SHARE
    near = seen.join(hot, ["k1", "k2"])
    far = seen.join(hot.select("k1", "k2"), ["k1", "k2"], "left_anti").join(found.select("k1", "k2", "last"), ["k1", "k2"])
    return cut(near.unionByName(far).where("id < last").groupBy("id", "mark").agg(F.collect_set("k1").alias("keys")))


def _kept(raw: bytes, lost: set[int], min_chars: int) -> tuple[bytes, int, int]:
    """Text of the lines that stay, number of lines, number dropped."""
    lines = raw.split(b"\n")
    stay = []
    for line in lines:
        key = line_key(line, min_chars)
        if key is None or short(xxhash.xxh3_128_digest(key)) not in lost:
            stay.append(line)
    return b"\n".join(stay), len(lines), len(lines) - len(stay)


def _apply(docs: DataFrame, lost: DataFrame, finish, schema) -> DataFrame:
    """Run `finish(batch, list of dropped-key lists)` over all columns of `docs`; only documents that may lose lines are joined.

    Columns travel as c0, c1, ... so that no name can clash; `schema` is that of the result.
    """
    words = docs.sparkSession.sparkContext.broadcast(IdFilter.build(lost.select(F.xxhash64("id", "mark").alias("at")), lost.count()).words)
    plain = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])
    ident, mark = F.coalesce(F.col(f"c{docs.columns.index('doc_id')}").cast("long"), F.lit(_NONE)), F.xxhash64(F.col(f"c{docs.columns.index('text')}").cast("string"))
    base = plain.select(F.xxhash64(ident, mark).alias("_at"), ident.alias("_id"), mark.alias("_mark"), "*")

    def own(batch: pa.RecordBatch, n: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(batch.columns[3 : 3 + n], batch.schema.names[3 : 3 + n])

    n = len(plain.columns)

    def pick(may: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = IdFilter(words.value)
            for batch in sliced(batches):
                at = pa.array(np.flatnonzero(held.may_hold(batch.column(0).to_numpy(zero_copy_only=False)) == may))
                if len(at):
                    part = batch.take(at)
                    yield part if may else finish(own(part, n), [None] * part.num_rows)

        return run

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            yield finish(own(batch, n), batch.column(3 + n).to_pylist())

    clean = base.mapInArrow(pick(False), schema)
    touched = base.mapInArrow(pick(True), base.schema).join(lost.toDF("_id", "_mark", "keys"), ["_id", "_mark"], "left")
    return clean.unionByName(touched.select("_at", "_id", "_mark", *plain.columns, "keys").mapInArrow(joined, schema))


def line_digests(docs: DataFrame, min_docs: int = 3, min_chars: int = 20, bits: int = BITS) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) of every row: what line dedup leaves of its text.

    A null or empty text is one empty line. An empty table gives no rows.
    """
    lost = repeated_lines(docs, min_docs, min_chars, bits)

    def finish(batch: pa.RecordBatch, keys: list) -> pa.RecordBatch:
        rows = [_kept(raw or b"", set(k or ()), min_chars) for raw, k in zip(raw_texts(batch, 1), keys)]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64()), pa.array([hashlib.sha256(r[0]).hexdigest() for r in rows], pa.string())],
            ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
        )

    return _apply(doc_texts(docs), lost, finish, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")


def drop_repeated_lines(docs: DataFrame, min_docs: int = 3, min_chars: int = 20, bits: int = BITS, drop_emptied: bool = False) -> DataFrame:
    """`docs` with its texts as line dedup leaves them and n_chars counted anew; every other column stays.

    Every row stays, unless `drop_emptied`: then rows go that lost lines and
    have nothing but white space left, as all they said stands in other rows.
    A text that isn't UTF-8 keeps its bytes; its n_chars stays as it is.
    """
    lost = repeated_lines(docs, min_docs, min_chars, bits)
    at = docs.columns.index("text")
    count = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def finish(batch: pa.RecordBatch, keys: list) -> pa.RecordBatch:
        columns = list(batch.columns)
        made = [(raw, 0, 0) if not k or raw is None else _kept(raw, set(k), min_chars) for raw, k in zip(raw_texts(batch, at), keys)]
        texts = [t for t, _, _ in made]
        columns[at] = pa.array(texts, pa.large_binary()).view(pa.large_string()).cast(pa.string())
        if count is not None:
            old = columns[count]
            anew = [o if not dropped else _length(t, o) for o, (t, _, dropped) in zip(old.to_pylist(), made)]
            columns[count] = pa.array(anew, old.type)
        out = pa.RecordBatch.from_arrays(columns, batch.schema.names)
        if not drop_emptied:
            return out
        return out.filter(pa.array([not dropped or bool(t.strip(_BLANK)) for t, _, dropped in made]))

    plain = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])
    return _apply(docs, lost, finish, plain.schema).toDF(*docs.columns)


def _length(raw: bytes, otherwise: int | None) -> int | None:
    try:
        return len(raw.decode("utf-8", "surrogatepass"))
    except UnicodeDecodeError:
        return otherwise
