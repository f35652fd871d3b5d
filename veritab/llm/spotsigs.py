"""SpotSigs fingerprints: chains of content words that follow common-word anchors.

A signature is an anchor with the next CHAIN content words after it; a
fingerprint is the set of a text's signatures, written as the base64 of sorted
32-bit hashes. Anchors are common words; where RUN content words have passed
without one, as in tables, lists and other languages, each further content word
is an anchor too, a rule that looks at the neighbourhood alone and so survives
edits elsewhere. A text too short for any chain has its words as a whole as its
one signature, and without words the text itself. Only a null or empty text has
an empty fingerprint.

Likeness is the Jaccard index of two sets. Sets whose sizes alone keep it under
a threshold are never intersected.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veritab.llm.common import block_units, cut, doc_texts, prepare, sliced, texts_of, units_of
from veritab.llm.hashing import _PLACE, mix, word_hashes
from veritab.llm.words import COMMON_WORDS

CHAIN, RUN, BLOCK = 2, 3, 512
#: Bytes of input files for a range of ids at least, where there are more ranges than the session has shuffle partitions.
RANGE_BYTES = 128 << 20
_WORD = re.compile(r"\w+")
_ANCHORS = np.sort(word_hashes([w.encode() for w in sorted(COMMON_WORDS)]))
_LEAST = -(1 << 63)


def signatures(text: str | None, chain: int = CHAIN) -> np.ndarray:
    """Sorted distinct 32-bit signatures of a whole text."""
    if not text:
        return np.empty(0, np.uint32)
    words = _WORD.findall(text.lower())
    h = word_hashes([w.encode() for w in words])
    if not len(h):
        return (word_hashes([text.encode()]) >> np.uint64(32)).astype(np.uint32)
    common = _ANCHORS[np.minimum(np.searchsorted(_ANCHORS, h), len(_ANCHORS) - 1)] == h
    content = np.flatnonzero(~common)
    passed = np.concatenate([[0], np.cumsum(common)])  # common words before each place
    alone = np.zeros(len(h), dtype=bool)
    alone[RUN:] = passed[RUN + 1 :] == passed[: max(0, len(h) - RUN)]  # the RUN words before and the word itself
    anchors = np.flatnonzero(common | alone)
    at = np.searchsorted(content, anchors, side="right")
    ok = at + chain <= len(content)
    anchors, at = anchors[ok], at[ok]
    if not len(anchors):
        acc = mix(np.atleast_1d((h * _PLACE[: len(h)]).sum(dtype=np.uint64)) if len(h) <= len(_PLACE) else word_hashes([" ".join(words).encode()]), 31)
    else:
        acc = h[anchors] * _PLACE[0]
        for k in range(chain):
            acc = acc + h[content[at + k]] * _PLACE[k + 1]
        acc = mix(acc, 21)
    return np.unique((acc >> np.uint64(32)).astype(np.uint32))


def fingerprint(signs: np.ndarray) -> str:
    return base64.b64encode(signs.astype(">u4").tobytes()).decode()


def from_fingerprint(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), ">u4").astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard index of two sorted sets, 1 for two empty ones; 0 where their sizes already keep it under `least`."""
    if not len(a) and not len(b):
        return 1.0
    if min(len(a), len(b)) < least * max(len(a), len(b)) or not len(a) or not len(b):
        return 0.0
    if len(a) == len(b) and (a == b).all():
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def edited(text: str, following: str) -> str:
    """The last floor(n/4) code points replaced by the first as many (or all) of the following text."""
    k = len(text) // 4
    return text[: len(text) - k] + following[:k]


def _in_order(docs: DataFrame) -> DataFrame:
    """(bucket, _id, text, ahead): rows spread over ranges of ids, each range sorted and followed by the first row after it.

    Ranges come from approximate quantiles of the ids. The least id of each
    range is found exactly, from ids alone (one number a range to the driver);
    rows with that id also go, marked `ahead`, to the range before.
    """
    spark = docs.sparkSession
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))  # of the files; nothing is read for it
    known = 0 < size < 1 << 60  # tables that aren't files have no known size
    parts = min(10_000, max(1, int(spark.conf.get("spark.sql.shuffle.partitions")), size // RANGE_BYTES if known else 1))
    rows = doc_texts(docs).select(F.coalesce("doc_id", F.lit(_LEAST)).alias("_id"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    splits = np.unique(np.array(rows.agg(F.percentile_approx("_id", [k / parts for k in range(1, parts)] or [0.5], 10_000)).first()[0] or [], dtype=np.int64))

    def leasts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, int] = {}
        for batch in batches:
            ids = batch.column(0).to_numpy()
            at = np.searchsorted(splits, ids, side="right")
            for b in np.unique(at):
                own = int(ids[at == b].min())
                found[int(b)] = min(found.get(int(b), own), own)
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.int64())], ["bucket", "least"])

    first = {r["bucket"]: r["least"] for r in rows.select("_id").mapInArrow(leasts, "bucket long, least long").groupBy("bucket").agg(F.min("least").alias("least")).collect()}
    held = sorted(first)
    before = {first[b]: held[k - 1] for k, b in enumerate(held)}  # the range before the first is the last
    keys = np.array(sorted(before), dtype=np.int64)
    values = np.array([before[k] for k in keys.tolist()], dtype=np.int64)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            ids = batch.column(0).to_numpy()
            at = np.searchsorted(splits, ids, side="right").astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.zeros(len(at), np.int32)), *batch.columns], ["bucket", "ahead", "_id", "doc_id", "text"])
            hit = np.searchsorted(keys, ids)
            again = np.flatnonzero(keys[np.minimum(hit, len(keys) - 1)] == ids)
            if len(again):
                part = batch.take(pa.array(again))
                yield pa.RecordBatch.from_arrays([pa.array(values[hit[again]].astype(np.int32)), pa.array(np.ones(len(again), np.int32)), *part.columns], ["bucket", "ahead", "_id", "doc_id", "text"])

    moved = rows.mapInArrow(spread, "bucket int, ahead int, _id long, doc_id long, text string")
    return moved.repartitionById(len(splits) + 1, "bucket").sortWithinPartitions("bucket", "ahead", "_id", "text")


def _compare(chain: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row that waits for its next one: (bucket, doc_id, text, signatures)
        for batch in sliced(batches):
            rows = []
            for bucket, ahead, doc_id, text in zip(*(batch.column(k).to_pylist() for k in (0, 1, 3)), texts_of(batch, 4)):
                if held is not None and held[0] != bucket:
                    held = None
                if held is None and ahead:
                    continue  # a further row with the id that leads the next range
                signs = signatures(text, chain)
                if held is not None:
                    _, own_id, own, own_signs = held
                    changed = edited(own, text)
                    new = signatures(changed, chain)
                    rows.append((own_id, len(own), hashlib.sha256(changed.encode()).hexdigest(), fingerprint(own_signs), fingerprint(new), likeness(own_signs, new), likeness(own_signs, signs)))
                held = None if ahead else (bucket, doc_id, text, signs)
            if rows:
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    return run


def fingerprints(docs: DataFrame, chain: int = CHAIN) -> DataFrame:
    """(doc_id, fingerprint, n_signatures) of every row's whole text."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            sets = [signatures(t, chain) for t in texts_of(batch, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([fingerprint(s) for s in sets]), pa.array([len(s) for s in sets], pa.int32())], ["doc_id", "fingerprint", "n_signatures"])

    return doc_texts(docs).mapInArrow(run, "doc_id long, fingerprint string, n_signatures int")


def edit_likeness(docs: DataFrame, chain: int = CHAIN) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness; see `edited`.

    Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next. The next document follows in ascending doc_id
    (nulls first; ties by text), the first one after the last; a lone document
    is its own next. A null text is empty. Texts are shuffled once.
    """
    prepare(docs.sparkSession)
    return _in_order(docs).mapInArrow(_compare(chain), "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def length_partition(size: int, least: float) -> int:
    """Partition of a set size: a set can be like only such of its own or a neighbouring partition."""
    return int(np.floor(np.log(max(size, 1)) / -np.log(least)))


def similar(docs: DataFrame, least: float = 0.8, chain: int = CHAIN) -> tuple[DataFrame, DataFrame]:
    """(links, members): links (a, b, likeness) of at least `least` between fingerprint classes, members (doc_id, class_id).

    class_id is the least doc_id with the same fingerprint; empty fingerprints
    and null ids have no links. Sets are indexed by their rarest signatures (as
    many as a like set can't all lack) within partitions of set length, and a
    set looks into its own and the next partition only. Hot signatures are cut
    into blocks. Two sets that meet first where too little of either is left
    aren't candidates; those that neither this nor their sizes rule out are
    intersected in full. All signatures move once, to be counted where they meet.
    """
    made = cut(fingerprints(docs, chain).where("doc_id is not null"))
    classes = cut(made.groupBy("fingerprint", "n_signatures").agg(F.min("doc_id").alias("class_id")))
    members = made.join(classes.select("fingerprint", "class_id"), "fingerprint").select("doc_id", "class_id")

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            sets = [from_fingerprint(f) for f in batch.column(1).to_pylist()]
            n = np.array([len(s) for s in sets])
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(batch.column(0).to_numpy(), n)), pa.array(np.repeat(n, n)), pa.array(np.concatenate(sets).astype(np.int64))], ["id", "n", "sign"])

    signs = classes.where("n_signatures > 0").select("class_id", "fingerprint").mapInArrow(explode, "id long, n long, sign long")
    order = Window.partitionBy("id").orderBy("often", "sign")
    ranked = signs.withColumn("often", F.count("*").over(Window.partitionBy("sign"))).where("often > 1").withColumn("rank", F.row_number().over(order) + F.col("n") - F.count("*").over(Window.partitionBy("id")))
    prefix = ranked.where(F.col("rank") <= F.col("n") - F.ceil(F.lit(least) * F.col("n")) + 1)
    part = F.floor(F.log(F.col("n").cast("double")) / F.lit(-np.log(least))).cast("int")
    own = prefix.select("id", "n", "sign", (F.col("n") - F.col("rank")).alias("left"), part.alias("part"))
    spread = own.select("id", "n", "sign", "left", F.explode(F.array(F.col("part"), F.col("part") + 1)).alias("part"))

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in units_of(batches):
            ids, n, left, side = (rows.column(k).to_numpy() for k in ("id", "n", "left", "side"))
            good = np.triu(np.minimum.outer(n, n) >= least * np.maximum.outer(n, n), 1)
            good &= 1 + np.minimum.outer(left, left) >= least / (1 + least) * np.add.outer(n, n) - 1e-9
            if (side != side[0]).any():
                good &= side[:, None] != side[None, :]
            i, j = np.nonzero(good)
            if len(i):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(ids[i], ids[j])), pa.array(np.maximum(ids[i], ids[j]))], ["a", "b"])

    units = block_units(cut(spread), ["sign", "part"], "id", BLOCK).select("unit", "id", "n", "left", "side")
    found = cut(units.repartition("unit").sortWithinPartitions("unit").mapInArrow(pairs, "a long, b long").where("a <> b").distinct())

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            x = np.array([likeness(from_fingerprint(p), from_fingerprint(q), least) for p, q in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())])
            at = pa.array(np.flatnonzero(x >= least))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(x).take(at)], ["a", "b", "likeness"])

    texts = classes.select(F.col("class_id").alias("a"), F.col("fingerprint").alias("fa"))
    joined = found.join(texts, "a").join(texts.toDF("b", "fb"), "b").select("a", "b", "fa", "fb")
    return joined.mapInArrow(verify, "a long, b long, likeness double"), members
