"""Contingency tables in long form, with wide pivots for display."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cells(df: DataFrame, row: str, col: str) -> DataFrame:
    """Observed cells ``(row, col, n)``; rows with a NULL key are dropped."""
    present = df.dropna(subset=[row, col])
    return present.groupBy(row, col).agg(F.count("*").alias("n"))


def with_margins(observed: DataFrame, row: str, col: str, n: str = "n") -> DataFrame:
    """``(row, col, n, row_total, col_total)`` of the observed cells.

    Each margin is an aggregate joined back by shuffle, whose skewed side may be split: a category with a third of all cells
    needs no task of its own. Rows with a NULL key and zero cells are dropped, equal cells are added up.
    """
    present = observed.dropna(subset=[row, col]).where(F.col(n) > 0)
    merged = present.groupBy(row, col).agg(F.sum(n).alias(n))
    out = merged
    for key, total in ((row, "row_total"), (col, "col_total")):
        margin = merged.groupBy(F.col(key).alias("_key")).agg(F.sum(n).alias(total))
        out = out.join(margin, F.col(key) == F.col("_key")).drop("_key")
    return out.select(row, col, n, "row_total", "col_total")


def contingency(df: DataFrame, row: str, col: str) -> DataFrame:
    """Observed cells with margins: ``(row, col, n, row_total, col_total, row_pct, expected)``. Absent cells are zero."""
    marked = with_margins(cells(df, row, col), row, col)
    total = df.dropna(subset=[row, col]).agg(F.count("*")).scalar()
    return marked.withColumns(
        {"row_pct": F.col("n") / F.col("row_total") * 100, "expected": F.col("row_total") / total * F.col("col_total")}
    )


def listed_cells(df: DataFrame, row: str, col: str, values: Sequence) -> DataFrame:
    """``(row, col, n)`` for every row category and each of the listed column values, zeros included; others are left out."""
    observed = cells(df, row, col)
    wanted = observed.select(row).distinct().withColumn(col, F.explode(F.array(*map(F.lit, dict.fromkeys(values)))))
    return wanted.join(observed, [row, col], "left").select(row, col, F.coalesce("n", F.lit(0)).alias("n"))


def complete_grid(observed: DataFrame, row: str, col: str, n: str = "n") -> DataFrame:
    """Add zero cells so that every row category meets every column category.

    Each row category packs its cells into a map and expands the list of column categories, so the
    only rows produced are those of the result.
    """
    keys = observed.agg(F.array_sort(F.collect_set(col))).scalar()
    packed = observed.groupBy(row).agg(
        F.map_from_entries(F.collect_list(F.struct(col, n))).alias("_cells"),
        F.sum(n).alias("row_total"),
    )
    expanded = packed.select(row, "row_total", "_cells", F.explode(keys).alias(col))
    count = F.coalesce(F.try_element_at("_cells", F.col(col)), F.lit(0))
    return expanded.select(row, col, count.alias(n), "row_total")


def crosstab_counts(df: DataFrame, row: str, col: str) -> DataFrame:
    return complete_grid(cells(df, row, col), row, col).drop("row_total")


def row_percent(observed: DataFrame, row: str, col: str, n: str = "n") -> DataFrame:
    """``(row, col, pct)`` where each row category adds up to 100."""
    grid = complete_grid(observed, row, col, n)
    return grid.select(row, col, (F.col(n) / F.col("row_total") * 100).alias("pct"))


def crosstab_percent(df: DataFrame, row: str, col: str) -> DataFrame:
    return row_percent(cells(df, row, col), row, col)


def pivot_sum(
    counts: DataFrame, row: str, col: str, n: str, values: Sequence[str]
) -> DataFrame:
    """Wide table of sums with absent cells 0. ``values`` fixes the columns."""
    present = counts.dropna(subset=[row, col])
    return present.groupBy(row).pivot(col, list(values)).agg(F.sum(n)).na.fill(0)


def wide_percent(wide: DataFrame, row: str) -> DataFrame:
    """Each row of a pivot divided by its own total, in percent."""
    names = [c for c in wide.columns if c != row]
    total = sum((F.col(f"`{c}`") for c in names[1:]), F.col(f"`{names[0]}`"))
    return wide.select(
        row, *[(F.try_divide(F.col(f"`{c}`"), total) * 100).alias(c) for c in names]
    )
