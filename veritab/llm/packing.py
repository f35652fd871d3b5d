"""Packing of token pieces into sequences of a fixed room, by exact complements and best fit.

Only the counts of piece lengths (at most `room` numbers) reach the driver.
There, from the longest length down, combinations of one, two and three
shorter lengths that exactly fill the gap are consumed under the counts that
are left; what remains is placed by best fit. The plan says, for each run of
equal sequences, which ranks of which length go to which offset. Pieces get
their rank within their length from counts of each task's pieces, so no length
is gathered anywhere, however frequent it is.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veritab.llm.common import cut, doc_texts, prepare, quoted, raw_texts, sliced
from veritab.llm.tokens import WordTokens

ROOM = 2048
VOCABULARY = "word_bpe_49k.json"
#: Characters tokenized at once in a worker.
CHUNK = 2_000_000

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, local long"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@cache
def _tokens(path: str) -> WordTokens:
    return WordTokens(path)


def _cut_pieces(path: str, room: int, end_id: int):
    end = int(end_id).to_bytes(4, "little")

    def flush(ids: list, texts: list[str], part: int, ranks: np.ndarray) -> pa.RecordBatch:
        rows: list[tuple] = []
        for doc_id, raw in zip(ids, _tokens(path).ids(texts)):
            raw += end
            for k, at in enumerate(range(0, len(raw), 4 * room)):
                own = raw[at : at + 4 * room]
                n = len(own) // 4
                rows.append((doc_id, k, at // 4, n, zlib.crc32(own), part, int(ranks[n])))
                ranks[n] += 1
        cols = list(zip(*rows))
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["doc_id", "piece", "start", "length", "ids_crc32", "part", "local"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, ranks = TaskContext.get().partitionId(), np.zeros(room + 1, dtype=np.int64)
        for batch in sliced(batches):
            ids, texts, held = [], [], 0
            for doc_id, raw in zip(batch.column(0).to_pylist(), raw_texts(batch, 1)):
                ids.append(doc_id)
                texts.append((raw or b"").decode("utf-8", "replace"))
                held += len(texts[-1])
                if held >= CHUNK:
                    yield flush(ids, texts, part, ranks)
                    ids, texts, held = [], [], 0
            if ids:
                yield flush(ids, texts, part, ranks)

    return run


def pieces(docs: DataFrame, room: int = ROOM, path: str | None = None, end_id: int = 0) -> DataFrame:
    """Pieces of every text, with the task that cut them and their rank in it among pieces of their length; checkpointed."""
    prepare(docs.sparkSession)
    return cut(doc_texts(docs).mapInArrow(_cut_pieces(path or vocabulary_path(), room, end_id), _PIECES))


class _Plan:
    """Runs of equal sequences: ranks [lo, lo + n) of a length go to sequences first, first + 1, ... at one offset."""

    def __init__(self, counts: np.ndarray):
        self.left, self.used = counts.copy(), np.zeros_like(counts)
        self.sequences, self.rows = 0, []

    def place(self, length: int, n: int, first: int, offset: int) -> None:
        """Put the next n pieces of a length into sequences from `first` on."""
        self.rows.append((length, int(self.used[length]), n, first, offset))
        self.used[length] += n
        self.left[length] -= n

    def open(self, lengths: list[int], n: int) -> int:
        """Start n sequences that each hold one piece of each length given."""
        first, offset = self.sequences, 0
        for length in lengths:
            self.place(length, n, first, offset)
            offset += length
        self.sequences += n
        return first


def _available(left: np.ndarray, combo: list[int]) -> int:
    return min(int(left[x]) // combo.count(x) for x in combo)


def _singles(left: np.ndarray, gap: int) -> list[int] | None:
    return [gap] if left[gap] else None


def _pairs(left: np.ndarray, gap: int) -> list[int] | None:
    """The pair of lengths with the larger one as long as can be that sums to gap."""
    hi = np.arange(gap - 1, (gap - 1) // 2, -1)
    ok = np.flatnonzero((left[hi] > 0) & (left[gap - hi] > 0))
    for k in ok:
        a = int(hi[k])
        if a != gap - a or left[a] > 1:
            return [a, gap - a]
    return None


def _triples(left: np.ndarray, gap: int) -> list[int] | None:
    for a in np.flatnonzero(left[: max(gap - 1, 0)])[::-1]:
        a = int(a)
        if 3 * a < gap:
            break
        left[a] -= 1
        pair = _pairs(left, gap - a)
        left[a] += 1
        if pair:
            return [a, *pair]
    return None


def plan_packing(counts: np.ndarray, room: int = ROOM) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """(rows of (length, first rank, number, first sequence, offset), number of sequences) for counts[length].

    Every piece gets one place; places of a sequence are gapless from 0.
    """
    plan = _Plan(np.asarray(counts, dtype=np.int64))
    left = plan.left
    for length in range(room, 0, -1):
        gap = room - length
        if gap == 0 and left[length]:
            plan.open([length], int(left[length]))
        for find in (_singles, _pairs, _triples):
            while gap and left[length]:
                left[length] -= 1
                combo = find(left, gap)
                left[length] += 1
                if combo is None:
                    break
                plan.open([length, *combo], _available(left, [length, *combo]))
    _best_fit(plan, room)
    assert not left.any()
    return plan.rows, plan.sequences


def _best_fit(plan: _Plan, room: int) -> None:
    """Place what is left, longest first, each into the open sequence with the least gap that holds it, whole runs at once."""
    runs: dict[int, list[tuple[int, int]]] = {}  # gap -> runs of (first sequence, number)
    for length in range(room, 0, -1):
        while n := int(plan.left[length]):
            gap = next((g for g in range(length, room) if runs.get(g)), None)
            if gap is None:
                fit = room // length
                new = max(1, n // fit)
                each = fit if n >= fit else n
                first = plan.open([length] * each, new)
                runs.setdefault(room - each * length, []).append((first, new))
                continue
            first, held = runs[gap].pop()
            k = min(n, held)
            plan.place(length, k, first, room - gap)
            runs.setdefault(gap - length, []).append((first, k))
            if held > k:
                runs[gap].append((first + k, held - k))


def _place(plan, room: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, key, lo, first, offset = plan.value
        for batch in batches:
            length = batch.schema.get_field_index("length")
            n, rank = batch.column(length).to_numpy(), batch.column(batch.num_columns - 1).to_numpy()
            at = np.searchsorted(key, n * (1 << 44) + rank, side="right") - 1
            seq, off = first[at] + rank - lo[at], offset[at]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(seq), pa.array(off)], [*batch.schema.names[:-1], "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, room: int = ROOM, path: str | None = None, end_id: int = 0) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece of every row of `docs`.

    A text's ids, then `end_id`, are cut into pieces of `room` only where they
    are longer. A null text is empty: its one piece is the end id. Repeated
    rows are packed each. An empty table gives no rows. sequence_id counts from
    0 and lengths tie in the order of tasks.
    """
    spark = docs.sparkSession
    made = pieces(docs, room, path, end_id)
    parts = made.groupBy("length", "part").count()
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.withColumn("base", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    counts = np.zeros(room + 1, dtype=np.int64)
    for r in parts.groupBy("length").agg(F.sum("count").alias("n")).collect():  # at most `room` rows
        counts[r["length"]] = r["n"]
    rows, _ = plan_packing(counts, room)
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)
    plan = spark.sparkContext.broadcast((None, table[:, 0] * (1 << 44) + table[:, 1], table[:, 1], table[:, 3], table[:, 4]))
    ranked = made.join(bases, ["length", "part"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("local")).alias("rank"))
    return ranked.mapInArrow(_place(plan, room), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
