"""Value counts, running totals, exact quantiles and ranks.

Exact order statistics are all derived from one intermediate: distinct values with their counts.
Partial aggregation shrinks the input before the only shuffle of raw values, so a hot value costs
one row per map task. Running totals over the distinct values are taken in two levels: values are
cut into slices at approximate quantiles, each slice is summed by its own task, and slice offsets
(a fixed number of rows per group) are added back. No task ever holds a whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def row_count(df: DataFrame) -> DataFrame:
    """Global row count as one row ``n``."""
    return df.agg(F.count("*").alias("n"))


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    """SQL-style group count: NULL keys form their own group."""
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def sum_counts(counts: DataFrame, *keys: str, n: str = "n") -> DataFrame:
    """Re-aggregate counts upward to fewer keys."""
    return counts.groupBy(*keys).agg(F.sum(n).alias(n))


def mean_by(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(*[F.avg(c).alias(c) for c in cols])


def mode_by(df: DataFrame, key: str, cols: Sequence[str], default: str = "N/A") -> DataFrame:
    """Most frequent value per group, smallest on ties, ``default`` when all are NULL.

    Counts per (group, column, value) come first, so no buffer holds a group's distinct values.
    """
    long = melt(df.where(F.col(key).isNotNull()), cols, by=[key], kind="string")
    counts = long.groupBy(key, "column", "value").agg(F.count("*").alias("n"))
    # min_by picks the smallest ordering: highest count first, then smallest value.
    order = F.when(F.col("value").isNotNull(), F.struct(-F.col("n"), F.col("value")))
    per_column = [
        F.coalesce(
            F.min_by("value", F.when(F.col("column") == c, order)), F.lit(default)
        ).alias(c)
        for c in cols
    ]
    return counts.groupBy(key).agg(*per_column)


def melt(
    df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), kind: str = "double"
) -> DataFrame:
    """Long form ``(by…, column, value)`` with values cast to ``kind``."""

    def value(c: str) -> Column:
        # Adding zero folds -0.0 into 0.0 so both count as one value.
        return F.col(c).cast(kind) + F.lit(0.0) if kind == "double" else F.col(c).cast(kind)

    wide = df.select(*by, *[value(c).alias(c) for c in cols if c not in by])
    return wide.unpivot(list(by), list(cols), "column", "value")


def value_counts(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Distinct non-NULL values with their counts, per group; NULL groups are dropped."""
    keys = [*by, value]
    present = df.dropna(subset=keys)
    return present.groupBy(*keys).agg(F.count("*").alias("n"))


def slice_count(spark: SparkSession) -> int:
    """Slices per group: the session's shuffle width as a power of two, 32 at least."""
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(32, 1 << (width - 1).bit_length())


def slice_of(cuts: Column, value: Column, slices: int) -> Column:
    """Number of the sorted ``slices - 1`` cuts below ``value``, by binary search."""
    halves = [slices >> i for i in range(1, slices.bit_length())]
    steps = F.array(*[F.lit(h) for h in halves])
    found = F.aggregate(
        steps,
        F.lit(0),
        lambda at, step: F.when(F.get(cuts, at + step - 1) < value, at + step).otherwise(at),
    )
    # Never NULL, so no null filter on it is pushed down to the raw rows.
    return F.coalesce(found, F.lit(0))


_PREVIOUS = (Window.unboundedPreceding, -1)


def _in_slices(counts: DataFrame, value: str, slices: int | None) -> DataFrame:
    """Add ``_slice``: where the value falls among quantiles of all distinct values together.

    Every (group, slice) then holds at most a slice's share of ``counts``, whatever the groups.
    """
    slices = slices or slice_count(counts.sparkSession)
    probs = [i / slices for i in range(1, slices)]
    x = F.col(value).cast("double")
    # Reading every carried column keeps this subquery's input the same as the main input, so
    # both use one shuffle.
    carried = [F.max(c).alias(f"c{i}") for i, c in enumerate(counts.columns) if c != value]
    cuts = counts.agg(
        F.struct(F.percentile_approx(x, probs, slices * 4).alias("at"), *carried)
    ).scalar()
    placed = counts.withColumn("_cuts", cuts["at"])
    return placed.withColumn("_slice", slice_of(F.col("_cuts"), x, slices)).drop("_cuts")


def _slice_offsets(placed: DataFrame, by: list[str], n: str) -> DataFrame:
    """``(by…, _slice, _w, _offset, total)``: rows in, before and around each slice."""
    group = Window.partitionBy(*by)
    before = F.sum("_w").over(group.orderBy("_slice").rowsBetween(*_PREVIOUS))
    return (
        placed.groupBy(*by, "_slice")
        .agg(F.sum(n).alias("_w"))
        .select(
            *by,
            "_slice",
            "_w",
            F.coalesce(before, F.lit(0)).alias("_offset"),
            F.sum("_w").over(group).alias("total"),
        )
    )


def _add_before(placed: DataFrame, value: str, by: list[str], n: str) -> DataFrame:
    """``before`` from the slice offset and a running sum inside the slice."""
    in_slice = Window.partitionBy(*by, "_slice").orderBy(value).rowsBetween(*_PREVIOUS)
    local = F.coalesce(F.sum(n).over(in_slice), F.lit(0))
    return placed.withColumn("_local", local)


def running_totals(
    counts: DataFrame,
    value: str,
    by: Sequence[str] = (),
    n: str = "n",
    slices: int | None = None,
) -> DataFrame:
    """Add ``before`` (rows with a smaller value) and ``total`` (rows of the group).

    ``counts`` holds one row per (by, value) with a numeric, non-NULL value. ``slices`` is a power
    of two.
    """
    by = list(by)
    placed = _in_slices(counts, value, slices)
    offsets = _slice_offsets(placed, by, n).drop("_w")
    return (
        _add_before(placed, value, by, n)
        .join(offsets, [*by, "_slice"])
        .withColumn("before", F.col("_local") + F.col("_offset"))
        .drop("_slice", "_local", "_offset")
    )


def _ranks(p: float) -> tuple[str, str, str]:
    """SQL for the position of quantile ``p`` among ``total`` rows, and the ranks around it."""
    position = f"((total - 1) * {float(p)!r}D)"
    low = f"floor({position})"
    return position, low, f"least({low} + 1, total - 1)"


def quantile_columns(probs: dict[str, float], value: str = "value") -> list[Column]:
    """Aggregates that read linear-interpolation quantiles off running totals."""

    def at(rank: str) -> str:
        return f"max(CASE WHEN before <= {rank} AND {rank} < before + n THEN `{value}` END)"

    columns = []
    for name, p in probs.items():
        position, low, high = _ranks(p)
        step = f"max({position} - {low}) * ({at(high)} - {at(low)})"
        columns.append(F.expr(f"{at(low)} + {step}").alias(name))
    return columns


def quantiles_of_counts(
    counts: DataFrame,
    probs: dict[str, float],
    by: Sequence[str] = (),
    value: str = "value",
    few_groups: bool = False,
    slices: int | None = None,
) -> DataFrame:
    """Exact quantiles with linear interpolation, and group sizes ``n``, from value counts.

    Slice totals tell which slices hold the wanted ranks; only those are shuffled and sorted.
    ``few_groups`` states that the number of groups is fixed by the caller, which bounds the list
    of wanted slices and lets it be broadcast.
    """
    by = list(by)
    placed = _in_slices(counts, value, slices)
    ranks = [rank for p in probs.values() for rank in _ranks(p)[1:]]
    wanted = " OR ".join(f"({r} >= _offset AND {r} < _offset + _w)" for r in ranks)
    needed = _slice_offsets(placed, by, "n").where(wanted).drop("_w")
    picked = placed.join(F.broadcast(needed) if few_groups else needed, [*by, "_slice"])
    ranked = _add_before(picked, value, by, "n").withColumn(
        "before", F.col("_local") + F.col("_offset")
    )
    return ranked.groupBy(*by).agg(
        F.max("total").alias("n"), *quantile_columns(probs, value)
    )


def numeric_modes(counts: DataFrame, by: Sequence[str], value: str = "value") -> DataFrame:
    """Most frequent value per group, smallest on ties: ``(by…, mode)``.

    Reducing to one value per count first leaves few rows and keeps both steps hash-aggregated.
    """
    per_count = counts.groupBy(*by, "n").agg(F.min(value).alias(value))
    return per_count.groupBy(*by).agg(F.max_by(value, "n").alias("mode"))


def exact_quantiles(
    df: DataFrame, cols: Sequence[str], probs: dict[str, float], by: Sequence[str] = ()
) -> DataFrame:
    """Exact quantiles with linear interpolation: one row per (by, column).

    ``probs`` maps output column name to probability.
    """
    keys = [*by, "column"]
    counts = value_counts(melt(df, cols, by), "value", keys)
    return quantiles_of_counts(counts, probs, keys, few_groups=not by).drop("n")


def medians(df: DataFrame, col: str, by: str | None = None, order: Sequence[str] = ()) -> DataFrame:
    """Exact median, overall or per group; ``order`` fixes the listed groups and their order."""
    keys = [by] if by else []
    counts = value_counts(df.select(*keys, F.col(col).cast("double").alias("value")), "value", keys)
    result = quantiles_of_counts(counts, {"median": 0.5}, keys, few_groups=by is None)
    if not order:
        return result
    levels = df.sparkSession.createDataFrame(list(enumerate(order)), f"position int, `{by}` string")
    return (
        levels.join(result, by, "left")
        .select("position", by, F.coalesce("n", F.lit(0)).alias("n"), "median")
        .orderBy("position")
    )


def midranks(counts: DataFrame, value: str, n: str = "n") -> DataFrame:
    """Average rank (ties share it) of each distinct value over all rows."""
    ranked = running_totals(counts, value, n=n)
    return ranked.withColumn("midrank", F.col("before") + (F.col(n) + 1) / 2)


def arg_max(df: DataFrame, key: str, score: str) -> DataFrame:
    """Key with the highest score, the smallest key on ties."""
    best = F.max_by(key, F.struct(F.col(score), -F.col(key)))
    return df.agg(best.alias(key), F.max(score).alias(score))
