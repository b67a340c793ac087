"""The numbers behind histograms, box plots, density curves and scatter plots."""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalframe.operators.association import correlations
from vitalframe.operators.counts import quantiles_of_counts, value_counts
from vitalframe.operators.decode import nan_to_null
from vitalframe.operators.sampling import sample_rows


#: Bandwidths beyond which a Gaussian kernel is zero in double precision: exp(-x * x / 2) underflows.
REACH = 38.7


def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """``(bin, lo, hi, n)`` for equal bins over min..max; the last bin is closed on both sides. NaN is missing."""
    df = nan_to_null(df)
    x = F.col(col).cast("double")
    edges = df.agg(F.min(x).alias("a"), F.max(x).alias("b"))
    flat = F.col("a") == F.col("b")
    edges = edges.select(
        F.when(flat, F.col("a") - 0.5).otherwise(F.col("a")).alias("a"),
        F.when(flat, F.col("b") + 0.5).otherwise(F.col("b")).alias("b"),
    )
    edge = edges.select(F.struct("a", "b")).scalar()
    present = df.where(x.isNotNull()).select(x.alias("_x"), edge.alias("_e"))
    position = F.floor((F.col("_x") - F.col("_e.a")) / (F.col("_e.b") - F.col("_e.a")) * bins)
    found = present.groupBy(F.least(position, F.lit(bins - 1)).cast("int").alias("bin")).agg(
        F.count("*").alias("n")
    )
    width = (F.col("b") - F.col("a")) / bins
    frame = edges.where(F.col("a").isNotNull()).select(
        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "a", width.alias("_w")
    )
    return frame.join(found, "bin", "left").select(
        "bin",
        (F.col("a") + F.col("bin") * F.col("_w")).alias("lo"),
        (F.col("a") + (F.col("bin") + 1) * F.col("_w")).alias("hi"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def _box_base(df: DataFrame, col: str, by: str | None, whisker: float) -> tuple:
    keys = [by] if by else ["_all"]
    df = nan_to_null(df)
    source = df if by else df.withColumn("_all", F.lit(0))
    flat = source.select(*keys, F.col(col).cast("double").alias("value"))
    counts = value_counts(flat, "value", keys)
    probs = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    quartiles = quantiles_of_counts(counts, probs, keys, few_groups=by is None)
    quartiles = quartiles.withColumnRenamed("n", "n_values")
    reach = (F.col("q3") - F.col("q1")) * whisker
    limits = quartiles.withColumn("lower", F.col("q1") - reach).withColumn(
        "upper", F.col("q3") + reach
    )
    return keys, counts.join(limits, keys)


def box_stats(
    df: DataFrame,
    col: str,
    by: str | None = None,
    order: Sequence[str] = (),
    whisker: float = 1.5,
) -> DataFrame:
    """Quartiles, whiskers (furthest value inside the limits) and flier counts, per group."""
    if order:
        df = df.where(F.col(by).isin(*order))
    keys, placed = _box_base(df, col, by, whisker)
    v, n = F.col("value"), F.col("n")
    inside_hi = F.max(F.when(v <= F.col("upper"), v))
    inside_lo = F.min(F.when(v >= F.col("lower"), v))
    boxes = placed.groupBy(*keys, "n_values", "q1", "median", "q3", "lower", "upper").agg(
        F.least(inside_lo, F.col("q1")).alias("whisker_lo"),
        F.greatest(inside_hi, F.col("q3")).alias("whisker_hi"),
        F.coalesce(F.sum(F.when(v < F.col("lower"), n)), F.lit(0)).alias("fliers_lo"),
        F.coalesce(F.sum(F.when(v > F.col("upper"), n)), F.lit(0)).alias("fliers_hi"),
    )
    shown = [by] if by else []
    boxes = boxes.select(
        *shown, F.col("n_values").alias("n"), "q1", "median", "q3",
        "whisker_lo", "whisker_hi", "fliers_lo", "fliers_hi",
    )
    if not order:
        return boxes
    place = F.array_position(F.array(*[F.lit(o) for o in order]), F.col(by))
    return boxes.orderBy(place)


def box_fliers(df: DataFrame, col: str, by: str | None = None, whisker: float = 1.5) -> DataFrame:
    """Distinct values outside the whisker limits with their counts."""
    _, placed = _box_base(df, col, by, whisker)
    outside = (F.col("value") < F.col("lower")) | (F.col("value") > F.col("upper"))
    return placed.where(outside).select(*([by] if by else []), "value", "n")


def density_curve(
    df: DataFrame, col: str, by: str, grid: int = 200, cut: float = 3.0
) -> DataFrame:
    """Gaussian density per group, each integrating to 1: ``(by, x, density)``.

    Scott's bandwidth; the grid reaches ``cut`` bandwidths past the data. Equal values are counted
    first and each distinct value is expanded, inside the map side of the final sum, to the grid points
    within ``REACH`` bandwidths, beyond which the kernel is zero; the shuffle carries grid points only. NaN is missing.
    """
    flat = nan_to_null(df.select(by, F.col(col).cast("double").alias("value")))
    spread = (
        flat.dropna()
        .groupBy(by)
        .agg(
            F.count("*").alias("_n"),
            F.stddev_samp("value").alias("_sd"),
            F.min("value").alias("_lo"),
            F.max("value").alias("_hi"),
        )
        .where(F.col("_sd") > 0)
        .withColumn("_h", F.col("_sd") * F.pow(F.col("_n"), F.lit(-0.2)))
    )
    step = (F.col("_hi") - F.col("_lo") + 2 * cut * F.col("_h")) / (grid - 1)
    spread = spread.withColumn("_x0", F.col("_lo") - cut * F.col("_h")).withColumn("_step", step)
    points = value_counts(flat, "value", [by]).join(spread.drop("_lo", "_hi", "_sd"), by)
    near = (F.col("value") - F.col("_x0")) / F.col("_step")
    reach = REACH * F.col("_h") / F.col("_step")
    first = F.greatest(F.ceil(near - reach), F.lit(0)).cast("int")
    last = F.least(F.floor(near + reach), F.lit(grid - 1)).cast("int")
    points = points.where(first <= last).withColumn("i", F.explode(F.sequence(first, last)))
    x = F.col("_x0") + F.col("i") * F.col("_step")
    u = (x - F.col("value")) / F.col("_h")
    scale = F.col("_n") * F.col("_h") * math.sqrt(2 * math.pi)
    # Points out of every value's reach are there, too.
    frame = spread.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(grid - 1)))).select(by, "i", x.alias("x"), F.lit(0.0).alias("_d"))
    met = points.select(by, "i", x.alias("x"), (F.col("n") * F.exp(-u * u / 2) / scale).alias("_d"))
    return met.unionByName(frame).groupBy(by, "i").agg(F.first("x").alias("x"), F.sum("_d").alias("density"))


def scatter_pairs(cols: Sequence[str], pairs: int = 6) -> list[tuple[str, str]]:
    """First unordered column pairs, in listed order."""
    return list(combinations(cols, 2))[:pairs]


def scatter_points(
    df: DataFrame, cols: Sequence[str], n: int = 5_000, seed: int = 42, key: Sequence[str] = ()
) -> DataFrame:
    """Sampled rows for all scatter plots of ``cols``."""
    return sample_rows(df, n, seed, key).select(*cols)


def scatter_correlations(df: DataFrame, cols: Sequence[str], pairs: int = 6) -> DataFrame:
    """``(a, b, r)`` of each plotted pair over all complete rows."""
    return correlations(df, scatter_pairs(cols, pairs))
