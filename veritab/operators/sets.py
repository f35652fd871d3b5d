"""Set and bag operations over two tables whose columns are matched by name."""

from __future__ import annotations

from pyspark.sql import DataFrame

#: As bags every row counts as often as it occurs, as sets once.
KINDS = ("union_all", "union", "intersect_all", "intersect", "except_all", "except")


def combine(a: DataFrame, b: DataFrame, how: str) -> DataFrame:
    """`a` and `b` combined; both must have the same columns, in any order. Nulls equal nulls."""
    if how not in KINDS:
        raise ValueError(f"unknown set operation: {how}")
    if sorted(a.columns) != sorted(b.columns):
        raise ValueError(f"columns differ: {sorted(a.columns)} and {sorted(b.columns)}")
    b = b.select(*a.columns)
    if how.startswith("union"):
        both = a.unionByName(b)
        return both if how == "union_all" else both.distinct()
    if how.startswith("intersect"):
        return a.intersectAll(b) if how == "intersect_all" else a.intersect(b)
    return a.exceptAll(b) if how == "except_all" else a.subtract(b)
