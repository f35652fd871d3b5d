"""Calibration: precision with an interval, by bucket and by threshold, over ruled rows (verdict right, wrong, cant_tell)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritab.operators.order import running

VERDICTS = ("right", "wrong", "cant_tell")
Z = 1.959963984540054


def wilson(right: Column, n: Column, z: float = Z) -> Column:
    """(low, high) of a share's interval, clamped to [0, 1]; the whole of it for no rulings."""
    n, p = n.cast("double"), right / n
    middle = p + z * z / (2 * n)
    half = z * F.sqrt(z * z / (4 * n * n) + p * (1 - p) / n)
    low, high = (middle - half) / (1 + z * z / n), (middle + half) / (1 + z * z / n)
    return F.struct(F.when(n > 0, F.greatest(F.lit(0.0), low)).otherwise(0.0).alias("low"), F.when(n > 0, F.least(F.lit(1.0), high)).otherwise(1.0).alias("high"))


def _counts(verdict: Column) -> list[Column]:
    return [F.count_if(verdict == "right").alias("n_right"), F.count_if(verdict == "wrong").alias("n_wrong"), F.count_if(verdict == "cant_tell").alias("n_set_aside")]


def _rated(df: DataFrame) -> DataFrame:
    n = F.col("n_right") + F.col("n_wrong")
    w = wilson(F.col("n_right"), n)
    return df.withColumn("n_ruled", n).withColumn("precision", F.when(n > 0, F.col("n_right") / n)).withColumn("low", w["low"]).withColumn("high", w["high"])


def precision(rows: DataFrame, verdict: str = "verdict") -> DataFrame:
    """One row: right over right and wrong; null where nothing was ruled. Set-aside rows count in neither."""
    return _rated(rows.agg(*_counts(F.col(verdict))))


def precision_table(rows: DataFrame, bucket: Sequence[str], verdict: str = "verdict") -> DataFrame:
    """Precision for each bucket."""
    return _rated(rows.groupBy(*bucket).agg(*_counts(F.col(verdict))))


def frontier(rows: DataFrame, score: str = "score", verdict: str = "verdict") -> DataFrame:
    """Precision and share kept at each score that occurs, used as a bar (score >= bar).

    n_accepted counts set-aside rows too, and the share is of all rows, those
    without a score included. Rows are first summed by score; the running sum
    then has a row for each distinct score only.
    """
    by_score = rows.where(F.col(score).isNotNull()).groupBy(F.col(score).alias("bar")).agg(*_counts(F.col(verdict)), F.count("*").alias("n"))
    names = {"n_right": "n_right", "n_wrong": "n_wrong", "n_set_aside": "n_set_aside", "n_accepted": "n"}
    run = running(by_score, [F.col("bar").desc()], {k: F.col(c) for k, c in names.items()}).select("bar", *names)
    total = rows.agg(F.count("*").alias("n_all"))
    return _rated(run.crossJoin(F.broadcast(total)).withColumn("kept", F.col("n_accepted") / F.col("n_all")).drop("n_all"))


def verdict_by_surface(rows: DataFrame, surface: str = "surface", verdict: str = "verdict") -> DataFrame:
    """Rulings of each kind for each surface, zeros filled in."""
    return rows.groupBy(surface).agg(*[F.count_if(F.col(verdict) == v).alias(v) for v in VERDICTS])
