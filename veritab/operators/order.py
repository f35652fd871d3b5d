"""Global row numbers and running sums over a range-partitioned sort: no task holds more than its range.

A window without a partition would bring all rows to one task. Here rows are
sorted in ranges and written once; what a range begins with comes from one row
a range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritab.operators.graph import checkpointed


def _ranges(rows: DataFrame, order: list[Column]) -> DataFrame:
    """`rows` sorted over all, with _part (range) and _at (place in the sort)."""
    spread = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    return checkpointed(spread).withColumn("_part", F.shiftright("_at", 33))


def running(rows: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """`rows` with running sums of non-negative or other numbers in the given order, each row included; null counts as nothing."""
    values = _ranges(rows.withColumns({f"_v_{k}": F.coalesce(c, F.lit(0)) for k, c in sums.items()}), order)
    totals = values.groupBy("_part").agg(*[F.sum(f"_v_{k}").alias(f"_t_{k}") for k in sums])
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    bases = totals.select("_part", *[F.coalesce(F.sum(f"_t_{k}").over(before), F.lit(0)).alias(f"_b_{k}") for k in sums])
    within = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    out = values.withColumns({f"_r_{k}": F.sum(f"_v_{k}").over(within) for k in sums}).join(F.broadcast(bases), "_part")
    return out.select(*[c for c in rows.columns if c not in sums], *[(F.col(f"_b_{k}") + F.col(f"_r_{k}")).alias(k) for k in sums])


def numbered(rows: DataFrame, order: list[Column], name: str = "row_number") -> DataFrame:
    """`rows` with global row numbers from 1 in the given order."""
    return running(rows, order, {name: F.lit(1)})


def ranked_within(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """`rows` with _n, a row's number in its group from 1, and _of, the group's size; a group of any size is spread over ranges."""
    all_ = numbered(rows, [*[F.col(k).asc_nulls_first() for k in keys], *order], "_all")
    if not keys:
        total = all_.agg(F.count("*").alias("_of"))
        return all_.crossJoin(F.broadcast(total)).withColumnRenamed("_all", "_n")
    groups = all_.groupBy(*keys).agg(F.min("_all").alias("_first"), F.count("*").alias("_of")).select(*[F.col(k).alias(f"_g{i}") for i, k in enumerate(keys)], "_first", "_of")
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_g{i}"))
    return all_.join(groups, same).withColumn("_n", F.col("_all") - F.col("_first") + 1).drop("_all", "_first", *[f"_g{i}" for i in range(len(keys))])
