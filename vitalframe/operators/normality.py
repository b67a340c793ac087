"""Normality tests: Shapiro-Wilk on bounded samples, Jarque-Bera on all rows."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalframe.functions.pvalues import chi2_tail
from vitalframe.operators.counts import melt
from vitalframe.operators.profile import moments
from vitalframe.operators.sampling import sample_per_group

SAMPLE_LIMIT = 5_000


def _shapiro_of_group():
    """Grouped function: W and p of one variable (Royston 1995, algorithm AS R94)."""
    def shapiro(pdf: pd.DataFrame) -> pd.DataFrame:
        from statistics import NormalDist

        # Published polynomial coefficients, lowest power first.
        last = (0.0, 0.221157, -0.147981, -2.071190, 4.434685, -2.706056)
        second = (0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633)
        small_gamma = (-2.273, 0.459)
        small_mean = (0.5440, -0.39978, 0.025054, -6.714e-4)
        small_log_sd = (1.3822, -0.77857, 0.062767, -0.0020322)
        large_mean = (-1.5861, -0.31082, -0.083751, 0.0038915)
        large_log_sd = (-0.4803, -0.082676, 0.0030302)

        def poly(coefficients, x):
            return sum(c * x**i for i, c in enumerate(coefficients))

        normal = NormalDist()
        x = np.sort(pdf["value"].to_numpy(dtype=float))
        n = len(x)
        name = pdf["column"].iloc[0]
        spread = float(((x - x.mean()) ** 2).sum())
        if n < 3 or spread == 0:
            return pd.DataFrame(
                {"column": [name], "n_sample": [n], "w": [None], "p_value": [None]}
            )
        if n == 3:
            weights = np.array([-np.sqrt(0.5), 0.0, np.sqrt(0.5)])
        else:
            m = np.array([normal.inv_cdf((i - 0.375) / (n + 0.25)) for i in range(1, n + 1)])
            norm2 = float(m @ m)
            u = 1 / np.sqrt(n)
            top = poly(last, u) + m[-1] / np.sqrt(norm2)
            weights = np.empty(n)
            if n > 5:
                next_top = poly(second, u) + m[-2] / np.sqrt(norm2)
                rest = (norm2 - 2 * m[-1] ** 2 - 2 * m[-2] ** 2) / (
                    1 - 2 * top**2 - 2 * next_top**2
                )
                weights[2:-2] = m[2:-2] / np.sqrt(rest)
                weights[1], weights[-2] = -next_top, next_top
            else:
                rest = (norm2 - 2 * m[-1] ** 2) / (1 - 2 * top**2)
                weights[1:-1] = m[1:-1] / np.sqrt(rest)
            weights[0], weights[-1] = -top, top
        w = min(float(weights @ x) ** 2 / spread, 1.0)
        if n == 3:
            p = 6 / np.pi * (np.arcsin(np.sqrt(w)) - np.arcsin(np.sqrt(0.75)))
            p = max(float(p), 0.0)
        elif w == 1.0:
            p = 1.0
        else:
            y = np.log(1 - w)
            if n <= 11:
                gamma = poly(small_gamma, n)
                if y >= gamma:
                    y = None
                else:
                    y = -np.log(gamma - y)
                    mean, sd = poly(small_mean, n), np.exp(poly(small_log_sd, n))
            else:
                mean = poly(large_mean, np.log(n))
                sd = np.exp(poly(large_log_sd, np.log(n)))
            p = 0.0 if y is None else normal.cdf(float((mean - y) / sd))
        return pd.DataFrame({"column": [name], "n_sample": [n], "w": [w], "p_value": [p]})

    return shapiro


def shapiro_wilk(
    df: DataFrame,
    cols: Sequence[str],
    n: int = SAMPLE_LIMIT,
    seed: int = 42,
    key: Sequence[str] = (),
    alpha: float = 0.05,
) -> DataFrame:
    """``(column, n_sample, w, p_value, normal, skew)`` per column with at least three values.

    Each column contributes at most ``n`` sampled values, so a group always fits one task; the
    skew comes from all rows.
    """
    long = melt(df, cols, by=key).dropna(subset=["value"])
    sampled = sample_per_group(long, "column", cols, n, seed, key).select("column", "value")
    tested = sampled.groupBy("column").applyInPandas(
        _shapiro_of_group(), "column string, n_sample long, w double, p_value double"
    )
    skews = moments(df, cols).select("column", F.round("skew", 3).alias("skew"))
    return (
        tested.where(F.col("n_sample") >= 3)
        .withColumn("normal", F.col("p_value") > alpha)
        .join(skews, "column")
    )


def jarque_bera_statistic(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, n, statistic)`` from population skewness and excess kurtosis of all rows."""
    from vitalframe.operators.profile import per_column

    def stats(c: str):
        x = F.col(c).cast("double")
        s, k = F.skewness(x), F.kurtosis(x)
        jb = F.count(x) / F.lit(6.0) * (s * s + k * k / 4)
        return F.struct(F.lit(c).alias("column"), F.count(x).alias("n"), jb.alias("statistic"))

    return per_column(df, {c: stats(c) for c in cols})


def jarque_bera(df: DataFrame, cols: Sequence[str], alpha: float = 0.05) -> DataFrame:
    stats = jarque_bera_statistic(df, cols).withColumn(
        "_t", chi2_tail(F.col("statistic"), F.lit(2))
    )
    return stats.select(
        "column", "n", "statistic", F.col("_t.p_value").alias("p_value"),
        F.col("_t.neg_log10_p").alias("neg_log10_p"),
        (F.col("_t.p_value") > alpha).alias("normal"),
    )
