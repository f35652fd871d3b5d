"""Session, checkpoint, naming and id-filter helpers shared by the operators of this folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veritab.shipping import ship

#: Rows of texts that a worker takes from an Arrow batch at once, and rows of numbers that it gathers.
TEXT_ROWS, NUMBER_ROWS = 512, 65_536
#: Most ids that are broadcast at once (8 bytes each); beyond it the join shuffles.
BROADCAST_IDS = 2_000_000
#: Bits of an id filter for each id, and in all (32 MB).
ID_BITS, ID_FILTER_BITS = 12, 1 << 28
#: A group is hot that has more than one in so many of all rows: at most so many groups are, which bounds their broadcast.
HOT_SHARE = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the driver's. One whose files give fewer splits than there are cores, as a single small file does, is spread over them."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if df._jdf.queryExecution().toRdd().getNumPartitions() < cores else df


def prepare(spark: SparkSession) -> None:
    """Set a checkpoint folder where the session has none, and see that workers have the package.

    A cluster names its shared folder in spark.checkpoint.dir. Only a local
    session may fall back to a temporary folder of this machine. The session's
    Arrow batches are set to TEXT_ROWS rows, as whole texts travel in them.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", TEXT_ROWS)
    ship(spark)
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="veritab-checkpoint-")
    sc.setCheckpointDir(named)


def cut(df: DataFrame) -> DataFrame:
    """Write `df` to the shared checkpoint folder and go on from the written copy (no lineage, outlives executors)."""
    prepare(df.sparkSession)
    return df.checkpoint()


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that `df` doesn't have, whatever its case."""
    taken = {c.lower() for c in df.columns}
    name = f"_{stem}"
    while name.lower() in taken:
        name = f"_{stem}_{uuid.uuid4().hex[:8]}"
    return name


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def doc_texts(docs: DataFrame) -> DataFrame:
    """(doc_id long, text string) of a documents table; whatever else it holds is left unread."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def raw_texts(batch: pa.RecordBatch, column: int) -> list[bytes | None]:
    """UTF-8 bytes of a string column without a round of decoding."""
    return batch.column(column).cast(pa.large_binary()).to_pylist()


def texts_of(batch: pa.RecordBatch, column: int) -> list[str | None]:
    """A string column as Python texts; bytes that aren't UTF-8 become U+FFFD."""
    return [None if raw is None else raw.decode("utf-8", "replace") for raw in raw_texts(batch, column)]


def without_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """`docs` without the rows whose doc_id is in `ids` (one column, distinct, checkpointed).

    Ids are broadcast up to BROADCAST_IDS of them, counted first; beyond that
    both sides are shuffled by id. Rows with a null doc_id stay.
    """
    name = fresh(docs, "gone")
    gone = ids.toDF(name)
    ident = docs["doc_id"].cast("long")
    if gone.count() <= BROADCAST_IDS:
        return docs.join(F.broadcast(gone), ident == gone[name], "left_anti")
    known = docs.where(ident.isNotNull())  # null ids would all go to one task with their texts
    return docs.where(ident.isNull()).unionByName(known.join(gone, known["doc_id"].cast("long") == gone[name], "left_anti"))


def sliced(batches: Iterator[pa.RecordBatch], rows: int = TEXT_ROWS) -> Iterator[pa.RecordBatch]:
    """Slices of at most `rows` rows."""
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)


def gathered(batches: Iterator[pa.RecordBatch], rows: int = NUMBER_ROWS) -> Iterator[pa.Table]:
    """Tables of at least `rows` rows, but for the last: small batches cost more than what is done with them."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def units_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of the rows of each unit (first column) of rows sorted by unit; units of one row are left out."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        unit = batch.column(0).to_numpy()
        if held and unit[0] != last:
            yield from _whole(held)
            held = []
        edge = np.flatnonzero(np.diff(unit)) + 1
        at = int(edge[-1]) if len(edge) else 0
        if at:
            held.append(batch.slice(0, at))
            yield from _whole(held)
            held = []
        held.append(batch.slice(at))
        last = unit[-1]
    if held:
        yield from _whole(held)


def _whole(parts: list[pa.RecordBatch]) -> Iterator[pa.Table]:
    rows = pa.Table.from_batches(parts).combine_chunks()
    unit = rows.column(0).to_numpy()
    cuts = [0, *(np.flatnonzero(np.diff(unit)) + 1).tolist(), len(unit)]
    for p, q in zip(cuts, cuts[1:]):
        if q - p > 1:
            yield rows.slice(p, q - p)


def small(rows: DataFrame, most: int = BROADCAST_IDS) -> DataFrame:
    """`rows` (checkpointed) marked for broadcast if there are at most `most`, by count."""
    return F.broadcast(rows) if rows.count() <= most else rows


def block_units(rows: DataFrame, keys: list[str], ident: str, block: int) -> DataFrame:
    """`rows` (checkpointed) with (unit long, side long): any two rows of a key group meet in exactly one unit.

    A group of up to `block` rows is a unit. Of a larger one of n rows,
    ceil(n / block) blocks are cut by a hash of `ident`; a unit is one block, or
    two of different `side`, so none outgrows about 2 x block rows however large
    its group, and n x n / block rows are made of n. Only the sizes of larger
    groups are joined, by broadcast where they are few.
    """
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > block)
    large = small(cut(sizes.select(*keys, F.ceil(F.col("_n") / F.lit(block)).cast("int").alias("_nb"))))
    own = rows.join(large, keys, "left").withColumn("_nb", F.coalesce("_nb", F.lit(1)))
    own = own.withColumn("side", F.pmod(F.xxhash64(F.lit("side"), ident), F.col("_nb")))
    spread = own.withColumn("_to", F.explode(F.sequence(F.lit(0), F.col("_nb") - 1)))
    return spread.withColumn("unit", F.xxhash64(*keys, F.least("side", "_to"), F.greatest("side", "_to"))).drop("_to", "_nb")


def hot_groups(rows: DataFrame, key: list[str], least: int) -> DataFrame:
    """(key, n) of groups of more than `least` rows and more than one in HOT_SHARE of all: at most HOT_SHARE groups; checkpointed."""
    sizes = rows.groupBy(*key).agg(F.count("*").alias("n"))
    total = rows.count()
    return cut(sizes.where((F.col("n") > least) & (F.col("n") * HOT_SHARE > total)))


def _positions(x: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    z = x.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    z = (z ^ (z >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    mask = np.uint64(bits - 1)
    return (z >> np.uint64(7)) & mask, (z >> np.uint64(35)) & mask


def filter_bits(items: int, per_item: int, most: int) -> int:
    """Bits of a filter for so many items: a power of two, at least 2^16 (or `most`), at most `most`."""
    bits = min(1 << 16, most)
    while bits < most and bits < items * per_item:
        bits *= 2
    return bits


class IdFilter:
    """A Bloom filter of row ids: may let others pass, never loses one."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.bits = len(words) * 64

    @classmethod
    def build(cls, ids: DataFrame, count: int, most: int = ID_FILTER_BITS) -> IdFilter:
        """OR the bit words of all ids of a one-column frame of `count` rows, ID_BITS an id up to `most`.

        Words are combined in the map tasks and again by word index, so at most
        bits / 64 rows reach the driver, whatever the number of ids.
        """
        bits = filter_bits(count, ID_BITS, most)

        def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = np.zeros(bits // 64, dtype=np.uint64)
            for batch in batches:
                x = batch.column(0).to_numpy(zero_copy_only=False)
                for p in _positions(x, bits):
                    np.bitwise_or.at(own, (p >> np.uint64(6)).astype(np.int64), np.uint64(1) << (p & np.uint64(63)))
            at = np.flatnonzero(own)
            for k in range(0, len(at), 65536):
                part = at[k : k + 65536]
                yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int64)), pa.array(own[part].view(np.int64))], ["at", "word"])

        name = ids.columns[0]
        found = ids.where(F.col(quoted(name)).isNotNull()).mapInArrow(words, "at long, word long").groupBy("at").agg(F.bit_or("word").alias("word")).toPandas()
        out = np.zeros(bits // 64, dtype=np.uint64)
        out[found["at"].to_numpy(dtype=np.int64)] = found["word"].to_numpy(dtype=np.int64).view(np.uint64)
        return cls(out)

    def may_hold(self, x: np.ndarray) -> np.ndarray:
        hit = np.ones(len(x), dtype=bool)
        for p in _positions(x, self.bits):
            hit &= (self.words[(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63))) & np.uint64(1) == 1
        return hit
