"""Outlier report by the interquartile rule."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalframe.functions.numbers import round_half_even
from vitalframe.operators.counts import melt, quantiles_of_counts, value_counts


def outside(df: DataFrame, col: str, lo: float, hi: float) -> DataFrame:
    """Rows outside ``lo..hi``."""
    return df.where((F.col(col) < lo) | (F.col(col) > hi))


def iqr_outliers(df: DataFrame, cols: Sequence[str], k: float = 1.5) -> DataFrame:
    """``(column, q1, q3, iqr, lower, upper, n, n_outliers, pct_outliers)``; skips flat columns.

    Quartiles and outlier counts both come from the value counts, so the data is read once. The
    broadcast limits are one row per listed column.
    """
    counts = value_counts(melt(df, cols), "value", ["column"])
    quartiles = (
        quantiles_of_counts(counts, {"q1": 0.25, "q3": 0.75}, ["column"], few_groups=True)
        .drop("n")
        .withColumn("iqr", F.col("q3") - F.col("q1"))
        .where(F.col("iqr") != 0)
        .withColumn("lower", F.col("q1") - k * F.col("iqr"))
        .withColumn("upper", F.col("q3") + k * F.col("iqr"))
    )
    beyond = (F.col("value") < F.col("lower")) | (F.col("value") > F.col("upper"))
    counted = (
        counts.join(F.broadcast(quartiles), "column")
        .groupBy("column", "q1", "q3", "iqr", "lower", "upper")
        .agg(
            F.sum("n").alias("n"),
            F.coalesce(F.sum(F.when(beyond, F.col("n"))), F.lit(0)).alias("n_outliers"),
        )
    )
    pct = round_half_even(F.col("n_outliers") / F.col("n") * 100, 2)
    return counted.withColumn("pct_outliers", pct)
