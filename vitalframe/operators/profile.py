"""Variable profiles and descriptive statistics, one row per column. NaN is missing, as NULL is."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalframe.functions.numbers import round_half_even
from vitalframe.operators.counts import exact_quantiles, melt, numeric_modes, value_counts
from vitalframe.operators.decode import nan_to_null

NUMERIC_TYPES = ("double", "float", "int", "bigint", "smallint", "tinyint")
QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def is_numeric(kind: str) -> bool:
    """Whether values of a type are numbers; decimals are."""
    return kind in NUMERIC_TYPES or kind.startswith("decimal")


def analysis_columns(df: DataFrame) -> list[str]:
    """Columns that are not lineage, i.e. do not start with an underscore."""
    return [c for c in df.columns if not c.startswith("_")]


def numeric_columns(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if is_numeric(t) and not c.startswith("_")]


def per_column(df: DataFrame, build: Mapping[str, Column]) -> DataFrame:
    """One aggregate over the whole frame, one struct per column, returned as rows."""
    wide = df.agg(*[s.alias(f"_c{i}") for i, s in enumerate(build.values())])
    return wide.select(F.inline(F.array(*[f"_c{i}" for i in range(len(build))])))


def variable_profile(
    df: DataFrame,
    cols: Sequence[str] | None = None,
    descriptions: Mapping[str, str] | None = None,
    approx: bool = False,
) -> DataFrame:
    """``(position, column, description, type, n_unique, n_null, pct_null, n_rows)``.

    Exact distinct counts group (column, value) pairs, which balances however skewed a column is.
    ``approx`` replaces that shuffle with a sketch per column in a single pass.
    """
    df = nan_to_null(df)
    cols = list(cols if cols is not None else analysis_columns(df))
    if approx:
        stats = per_column(
            df,
            {
                c: F.struct(
                    F.lit(c).alias("column"),
                    F.approx_count_distinct(c).alias("n_unique"),
                    F.count_if(F.col(c).isNull()).alias("n_null"),
                    F.count("*").alias("n_rows"),
                )
                for c in cols
            },
        )
    else:
        counts = (
            melt(df, cols, kind="string").groupBy("column", "value").agg(F.count("*").alias("n"))
        )
        stats = counts.groupBy("column").agg(
            F.count("value").alias("n_unique"),
            F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias(
                "n_null"
            ),
            F.sum("n").alias("n_rows"),
        )
    types = dict(df.dtypes)
    known = descriptions or {}
    listed = df.sparkSession.createDataFrame(
        [(i, c, known.get(c, c), types[c]) for i, c in enumerate(cols)],
        "position int, column string, description string, type string",
    )
    filled = listed.join(stats, "column", "left").na.fill(
        0, ["n_unique", "n_null", "n_rows"]
    )
    pct = F.when(F.col("n_rows") > 0, round_half_even(F.col("n_null") / F.col("n_rows") * 100, 1))
    return filled.select(
        "position", "column", "description", "type", "n_unique", "n_null",
        pct.alias("pct_null"), "n_rows",
    )


def missingness(df: DataFrame, min_pct: float = 0.0, cols: Sequence[str] | None = None) -> DataFrame:
    """``(column, n_null, pct_null)`` for columns above a NULL share; one pass, no shuffle."""
    df = nan_to_null(df)
    cols = list(cols if cols is not None else analysis_columns(df))
    stats = per_column(
        df,
        {
            c: F.struct(
                F.lit(c).alias("column"),
                F.count_if(F.col(c).isNull()).alias("n_null"),
                round_half_even(F.count_if(F.col(c).isNull()) / F.count("*") * 100, 1).alias("pct_null"),
            )
            for c in cols
        },
    )
    return stats.where(F.col("pct_null") > min_pct)


def identifier_like(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``(column, year_share, is_identifier)``: ``reg`` in the name or mostly year values."""
    cols = list(cols if cols is not None else numeric_columns(df))
    stats = per_column(
        df,
        {
            c: F.struct(
                F.lit(c).alias("column"),
                F.avg(F.col(c).between(2000, 2030).cast("double")).alias("year_share"),
            )
            for c in cols
        },
    )
    flagged = F.col("column").contains("reg") | (F.coalesce("year_share", F.lit(0.0)) > 0.9)
    return stats.withColumn("is_identifier", flagged)


def select_columns(
    profile: DataFrame,
    kind: str,
    min_unique: int = 0,
    max_unique: int | None = None,
    min_cover: float = 0.0,
) -> DataFrame:
    """Profile rows of ``numeric`` or ``categorical`` columns by cardinality and coverage."""
    numeric = F.col("type").isin(*NUMERIC_TYPES) | F.col("type").startswith("decimal")
    rule = numeric if kind == "numeric" else ~numeric
    rule &= F.col("n_unique") >= min_unique
    if max_unique is not None:
        rule &= F.col("n_unique") <= max_unique
    rule &= (F.col("n_rows") - F.col("n_null")) > F.col("n_rows") * min_cover
    return profile.where(rule)


def moments(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, extremes and bias-corrected shape in one pass."""
    df = nan_to_null(df)

    def stats(c: str) -> Column:
        x = F.col(c).cast("double")
        n = F.count(x).cast("double")
        flat = F.stddev_pop(x) == 0
        skew = F.when(flat, 0.0).otherwise(F.skewness(x) * F.sqrt(n * (n - 1)) / (n - 2))
        kurt = F.when(flat, 0.0).otherwise(
            (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(x) + 6)
        )
        return F.struct(
            F.lit(c).alias("column"),
            F.count(x).alias("n"),
            F.avg(x).alias("mean"),
            F.stddev_samp(x).alias("std"),
            F.min(x).alias("min"),
            F.max(x).alias("max"),
            F.when(n > 2, skew).alias("skew"),
            F.when(n > 3, kurt).alias("kurtosis"),
        )

    return per_column(df, {c: stats(c) for c in cols})


def quartiles(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, q25, q50, q75)`` with linear interpolation."""
    return exact_quantiles(nan_to_null(df), cols, QUARTILES)


def order_statistics(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, q25, q50, q75, mode)``; smallest mode on ties."""
    modes = numeric_modes(value_counts(melt(nan_to_null(df), cols), "value", ["column"]), ["column"])
    return quartiles(df, cols).join(modes, "column")


def numeric_describe(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """``(column, n, mean, std, min, q25, q50, q75, max)``.

    ``approx`` answers the quartiles from sketches, without any shuffle of values.
    """
    if approx:
        df = nan_to_null(df)
        probs = list(QUARTILES.values())
        sketches = per_column(
            df,
            {
                c: F.struct(
                    F.lit(c).alias("column"),
                    F.percentile_approx(F.col(c).cast("double"), probs).alias("q"),
                )
                for c in cols
            },
        )
        points = sketches.select(
            "column", *[F.col("q")[i].alias(name) for i, name in enumerate(QUARTILES)]
        )
    else:
        points = quartiles(df, cols)
    joined = moments(df, cols).join(points, "column", "left")
    return joined.select("column", "n", "mean", "std", "min", "q25", "q50", "q75", "max")


def numeric_shape(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, median, mode, skew, kurtosis, cv_pct, iqr)``."""
    joined = moments(df, cols).join(order_statistics(df, cols), "column", "left")
    return joined.select(
        "column",
        F.col("q50").alias("median"),
        "mode",
        "skew",
        "kurtosis",
        round_half_even(F.try_divide("std", "mean") * 100, 2).alias("cv_pct"),
        (F.col("q75") - F.col("q25")).alias("iqr"),
    )


def summarize(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Summary of every column in one pass: type, range, sketches, moments, NULL share."""
    df = nan_to_null(df)
    types = dict(df.dtypes)
    cols = list(cols if cols is not None else df.columns)

    def stats(c: str) -> Column:
        col = F.col(f"`{c}`")
        numeric = is_numeric(types[c])
        x = col.cast("double") if numeric else F.lit(None).cast("double")
        if numeric:
            quartiles = F.percentile_approx(x, [0.25, 0.5, 0.75])
        else:
            quartiles = F.lit(None).cast("array<double>")
        return F.struct(
            F.lit(c).alias("column_name"),
            F.lit(types[c]).alias("column_type"),
            F.min(col).cast("string").alias("min"),
            F.max(col).cast("string").alias("max"),
            F.approx_count_distinct(col).alias("approx_unique"),
            (F.avg(x) if numeric else x).alias("avg"),
            (F.stddev_samp(x) if numeric else x).alias("std"),
            quartiles.alias("q"),
            F.count("*").alias("count"),
            round_half_even(F.count_if(col.isNull()) / F.count("*") * 100, 2).alias("null_percentage"),
        )

    rows = per_column(df, {c: stats(c) for c in cols})
    names = ("q25", "q50", "q75")
    return rows.select(
        "column_name", "column_type", "min", "max", "approx_unique", "avg", "std",
        *[F.get("q", F.lit(i)).alias(n) for i, n in enumerate(names)],
        "count", "null_percentage",
    )
