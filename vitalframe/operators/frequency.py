"""Frequency tables, group shares, top-n groups and series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitalframe.functions.numbers import round_half_even
from vitalframe.operators.counts import count_by, melt
from vitalframe.sources.scratch import materialise


def _placed(counts: DataFrame) -> DataFrame:
    """Add ``position`` and ``_cum``, the running total, per column by falling count.

    The counts are range-sorted and written once; positions within each range get the sizes of the ranges
    before. A column with any number of values is never in one task.
    """
    ranged = counts.repartitionByRange("column", F.desc("n"), "value").withColumn("_range", F.spark_partition_id())
    ranged = materialise(ranged, "frequencies")
    within = Window.partitionBy("column", "_range").orderBy(F.desc("n"), "value")
    before = Window.partitionBy("column").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("column", "_range").agg(F.count("*").alias("_values"), F.sum("n").alias("_rows"))
    offsets = sizes.select(
        "column", "_range", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in ("_values", "_rows")]
    )
    running = F.sum("n").over(within.rowsBetween(Window.unboundedPreceding, 0))
    placed = ranged.withColumns({"position": F.row_number().over(within), "_cum": running})
    placed = placed.join(offsets, ["column", "_range"])
    return placed.withColumns(
        {"position": (F.col("position") + F.col("_values")).cast("int"), "_cum": F.col("_cum") + F.col("_rows")}
    )


def frequency_table(df: DataFrame, cols: Sequence[str], top: int | None = None) -> DataFrame:
    """``(column, position, value, n, pct, cum_pct, n_categories, others)`` per column.

    Complete for any number of values; ``top`` asks for the largest ones only. Counts come first, so
    what follows sees categories, not rows.
    """
    counts = melt(df, cols, kind="string").dropna(subset=["value"])
    counts = counts.groupBy("column", "value").agg(F.count("*").alias("n"))
    totals = counts.groupBy("column").agg(
        F.sum("n").alias("_total"), F.count("*").alias("n_categories")
    )
    if top is None:
        ranked = _placed(counts)
    else:
        # The rank filter is applied inside the map tasks too, so a column with many values is cut
        # down before it reaches one task.
        by_size = Window.partitionBy("column").orderBy(F.desc("n"), "value")
        ranked = counts.withColumn("position", F.row_number().over(by_size)).where(F.col("position") <= top)
        ranked = ranked.withColumn("_cum", F.sum("n").over(by_size.rowsBetween(Window.unboundedPreceding, 0)))
    others = F.lit(0).cast("long") if top is None else F.greatest(F.col("n_categories") - top, F.lit(0))
    return ranked.join(totals, "column").select(
        "column",
        "position",
        "value",
        "n",
        round_half_even(F.col("n") / F.col("_total") * 100, 2).alias("pct"),
        round_half_even(F.col("_cum") / F.col("_total") * 100, 2).alias("cum_pct"),
        "n_categories",
        others.alias("others"),
    )


def bar_data(df: DataFrame, col: str, top: int = 20) -> DataFrame:
    """Largest categories with their share of the shown total, in percent."""
    shown = (
        count_by(df.where(F.col(col).isNotNull()), col)
        .orderBy(F.desc("n"), col)
        .limit(top)
        .withColumnRenamed(col, "value")
    )
    total = shown.agg(F.sum("n")).scalar()
    return shown.withColumn("pct", round_half_even(F.col("n") / total * 100, 1))


def group_share(df: DataFrame, key: str) -> DataFrame:
    """Group sizes and their percentage of all rows."""
    counts = count_by(df.where(F.col(key).isNotNull()), key)
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("pct", F.col("n") / total * 100)


def top_groups(
    counts: DataFrame, key: str, n: int = 5, must: str | None = None, weight: str = "n"
) -> DataFrame:
    """Keys of the ``n`` largest groups, plus one named group."""
    totals = (
        counts.where(F.col(key).isNotNull()).groupBy(key).agg(F.sum(weight).alias("total"))
    )
    keys = totals.orderBy(F.desc("total"), key).limit(n).select(key)
    if must is None:
        return keys
    named = counts.sparkSession.range(1).select(F.lit(must).alias(key))
    return keys.union(named).distinct()


def group_series(
    counts: DataFrame, time: str, key: str, n: int = 5, must: str | None = None, weight: str = "n"
) -> DataFrame:
    """Counts per time and group for the top groups only."""
    chosen = top_groups(counts, key, n, must, weight)
    picked = counts.join(chosen, key, "left_semi")
    return picked.groupBy(time, key).agg(F.sum(weight).alias(weight)).orderBy(time, key)


def distribution(df: DataFrame, col: str) -> DataFrame:
    """Counts of each non-NULL value, ordered by value."""
    return count_by(df.where(F.col(col).isNotNull()), col).orderBy(col)


def relative_change(counts: DataFrame, time: str, start: int, end: int, n: str = "n") -> DataFrame:
    """Percentage change of a count between two points in time."""

    def at(t: int):
        return F.sum(F.when(F.col(time) == t, F.col(n)))

    change = F.try_divide((at(end) - at(start)) * 100.0, at(start))
    return counts.agg(
        at(start).alias("n_start"), at(end).alias("n_end"), change.alias("pct_change")
    )


def merge_series(
    left: DataFrame, right: DataFrame, key: str, fill: int = 0
) -> DataFrame:
    """Left equi-join of two aggregates on ``key``; absent values become ``fill``."""
    return left.join(right, key, "left").na.fill(fill)
