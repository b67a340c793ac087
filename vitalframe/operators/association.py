"""Correlation and hypothesis tests.

Every test reduces the data to a small aggregate first and returns one row
``(test, n, statistic, dof, p_value, neg_log10_p, reject)``.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalframe.functions.pvalues import chi2_tail, normal_tail
from vitalframe.operators.counts import midranks
from vitalframe.operators.crosstab import cells, complete_grid, with_margins

ALPHA = 0.05


def correlations(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """``(a, b, r)``: Pearson over the rows where both are present, all pairs in one pass."""
    one_pass = df.agg(
        *[
            F.struct(
                F.lit(a).alias("a"),
                F.lit(b).alias("b"),
                F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias("r"),
            ).alias(f"_p{i}")
            for i, (a, b) in enumerate(pairs)
        ]
    )
    return one_pass.select(F.inline(F.array(*[f"_p{i}" for i in range(len(pairs))])))


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Full symmetric matrix in long form; each unordered pair is computed once."""
    upper = correlations(df, [*combinations(cols, 2), *[(c, c) for c in cols]])
    both = F.array(
        F.struct(F.col("a"), F.col("b"), F.col("r")),
        F.struct(F.col("b").alias("a"), F.col("a").alias("b"), F.col("r")),
    )
    mirrored = F.when(F.col("a") == F.col("b"), F.slice(both, 1, 1)).otherwise(both)
    return upper.select(F.inline(mirrored))


def ranked_correlations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Unordered pairs by falling absolute correlation, rounded to four decimals."""
    rounded = correlations(df, list(combinations(cols, 2))).withColumn("r", F.round("r", 4))
    return rounded.orderBy(F.abs("r").desc_nulls_last(), "a", "b")


def decision(p: Column, alpha: float = ALPHA) -> Column:
    """Text of the decision on the null hypothesis."""
    return F.when(p < alpha, "reject H0").when(p.isNotNull(), "keep H0")


def _test_row(stats: DataFrame, name: str, tail: Column, alpha: float) -> DataFrame:
    """Attach tail probability and decision to a one-row ``(n, statistic, dof)`` frame."""
    with_tail = stats.withColumn("_t", tail)
    return with_tail.select(
        F.lit(name).alias("test"),
        F.col("n"),
        F.col("statistic"),
        F.col("dof"),
        F.col("_t.p_value").alias("p_value"),
        F.col("_t.neg_log10_p").alias("neg_log10_p"),
        (F.col("_t.p_value") < alpha).alias("reject"),
    )


def chi2_statistic(observed: DataFrame, row: str, col: str, n: str = "n") -> DataFrame:
    """``(n, statistic, dof)`` of a contingency table given as long cells.

    Zero cells need not be present: each adds its expected count, and together they add what the observed cells'
    expected counts leave of N. At one degree of freedom all four deviations are equal, so the continuity correction
    also follows from the margins.
    """
    marked = with_margins(observed, row, col, n)
    grand = observed.dropna(subset=[row, col]).where(F.col(n) > 0).agg(F.sum(n).cast("double")).scalar()
    o, r, c = (F.col(x).cast("double") for x in (n, "row_total", "col_total"))
    expected = r / grand * c
    # 1/R spread over the cells of its row, so that summing cells sums rows once; same for C.
    per_row = o / (r * r)
    per_col = o / (c * c)
    sums = marked.agg(
        F.sum(o).alias("_n"),
        F.count("*").alias("_cells"),
        F.sum((o - expected) * (o - expected) / expected).alias("_q"),
        F.sum(expected).alias("_e"),
        F.sum(per_row).alias("_ir"),
        F.sum(per_col).alias("_ic"),
        F.count_distinct(row).alias("_nr"),
        F.count_distinct(col).alias("_nc"),
        F.first(F.struct(o.alias("o"), r.alias("r"), c.alias("c"))).alias("_any"),
    )
    total = F.col("_n")
    deviation = F.abs(F.col("_any.o") - F.col("_any.r") * F.col("_any.c") / total)
    corrected = F.greatest(deviation - 0.5, F.lit(0.0))
    yates = corrected * corrected * total * F.col("_ir") * F.col("_ic")
    absent = F.when(F.col("_cells") < F.col("_nr") * F.col("_nc"), F.greatest(total - F.col("_e"), F.lit(0.0))).otherwise(0.0)
    plain = F.col("_q") + absent
    dof = (F.col("_nr") - 1) * (F.col("_nc") - 1)
    return sums.select(
        total.cast("long").alias("n"),
        F.when(dof == 1, yates).when(dof > 1, plain).otherwise(0.0).alias("statistic"),
        dof.cast("long").alias("dof"),
    )


def chi2_independence(
    observed: DataFrame, row: str, col: str, n: str = "n", alpha: float = ALPHA
) -> DataFrame:
    """Chi-square test of independence on long cells."""
    stats = chi2_statistic(observed, row, col, n)
    tail = chi2_tail(F.col("statistic"), F.col("dof"))
    return _test_row(stats, "chi2", tail, alpha)


def chi2_of_columns(df: DataFrame, row: str, col: str, alpha: float = ALPHA) -> DataFrame:
    return chi2_independence(cells(df, row, col), row, col, "n", alpha)


def expected_counts(observed: DataFrame, row: str, col: str, n: str = "n") -> DataFrame:
    """``(row, col, n, expected)`` for every cell, zero cells included."""
    grid = complete_grid(observed.dropna(subset=[row, col]), row, col, n)
    column_total = F.sum(n).over(Window.partitionBy(col))
    total = observed.dropna(subset=[row, col]).agg(F.sum(n)).scalar()
    return grid.select(
        row, col, n, (F.col("row_total") * column_total / total).alias("expected")
    )


def kruskal_statistic(
    df: DataFrame, group: str, value: str, levels: Sequence[str]
) -> DataFrame:
    """``(n, statistic, dof)`` with tie correction.

    One aggregate holds the count of each level per distinct value; ranks are then taken over
    distinct values. Rank sums are centred on the mean rank to keep precision at large n.
    """
    x = F.col(value).cast("double")
    present = df.where(F.col(group).isin(*levels) & x.isNotNull())
    counts = present.groupBy((x + 0.0).alias("_x")).agg(
        F.count("*").alias("n"),
        *[F.count_if(F.col(group) == level).alias(f"_g{i}") for i, level in enumerate(levels)],
    )
    ranked = midranks(counts, "_x")
    total = F.col("total").cast("double")
    centred = F.col("midrank") - (total + 1) / 2
    ties = F.col("n").cast("double")
    sums = ranked.agg(
        F.max(total).alias("_n"),
        F.sum(ties * ties * ties - ties).alias("_t"),
        *[F.sum(F.col(f"_g{i}")).alias(f"_n{i}") for i in range(len(levels))],
        *[F.sum(F.col(f"_g{i}") * centred).alias(f"_r{i}") for i in range(len(levels))],
    )
    n = F.col("_n")
    between = F.lit(0.0)
    for i in range(len(levels)):
        share = F.try_divide(F.col(f"_r{i}") * F.col(f"_r{i}"), F.col(f"_n{i}"))
        between = between + F.coalesce(share, F.lit(0.0))
    used = F.lit(0)
    for i in range(len(levels)):
        used = used + F.when(F.col(f"_n{i}") > 0, 1).otherwise(0)
    raw = between * 12 / (n * (n + 1))
    corrected = F.try_divide(raw, 1 - F.col("_t") / (n * n * n - n))
    return sums.select(
        n.cast("long").alias("n"), corrected.alias("statistic"), (used - 1).cast("long").alias("dof")
    )


def kruskal_wallis(
    df: DataFrame, group: str, value: str, levels: Sequence[str], alpha: float = ALPHA
) -> DataFrame:
    """Kruskal-Wallis H over the listed groups."""
    stats = kruskal_statistic(df, group, value, levels)
    return _test_row(stats, "kruskal", chi2_tail(F.col("statistic"), F.col("dof")), alpha)


def proportion_statistic(df: DataFrame, condition: Column, p0: float = 0.5) -> DataFrame:
    """``(n, hits, p_hat, statistic)`` of a one-sample proportion, in one pass.

    Rows where the condition is NULL count as misses.
    """
    share = F.try_divide(F.count_if(condition), F.count("*"))
    z = (share - p0) / F.sqrt(F.lit(p0 * (1 - p0)) / F.count("*"))
    return df.agg(
        F.count("*").alias("n"),
        F.count_if(condition).alias("hits"),
        share.alias("p_hat"),
        F.when(F.count("*") > 0, z).alias("statistic"),
    )


def proportion_test(
    df: DataFrame, condition: Column, p0: float = 0.5, alpha: float = ALPHA
) -> DataFrame:
    """Upper-tailed z test of a proportion against ``p0``."""
    stats = proportion_statistic(df, condition, p0)
    tail = stats.withColumn("_t", normal_tail(F.col("statistic")))
    return tail.select(
        F.lit("proportion_z").alias("test"),
        "n",
        "hits",
        "p_hat",
        "statistic",
        F.col("_t.p_value").alias("p_value"),
        F.col("_t.neg_log10_p").alias("neg_log10_p"),
        (F.col("_t.p_value") < alpha).alias("reject"),
    )


def share_within(df: DataFrame, condition: Column, within: Column | None = None) -> DataFrame:
    """``(hits, base, share)`` of a condition in all rows, or among the rows of a subgroup."""
    base = F.count_if(within) if within is not None else F.count("*")
    hit = condition & within if within is not None else condition
    return df.agg(
        F.count_if(hit).alias("hits"),
        base.alias("base"),
        F.try_divide(F.count_if(hit), base).alias("share"),
    )


def rate_ratio(df: DataFrame, group: str, condition: Column, a: str, b: str) -> DataFrame:
    """``(rate_a, rate_b, ratio)`` of a condition in two groups, in one pass."""

    def rate(g: str) -> Column:
        inside = F.col(group) == g
        return F.try_divide(F.count_if(inside & condition), F.count_if(inside))

    return df.agg(
        rate(a).alias("rate_a"),
        rate(b).alias("rate_b"),
        F.try_divide(rate(a), rate(b)).alias("ratio"),
    )
