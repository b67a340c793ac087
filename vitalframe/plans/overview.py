"""Dataset overviews composed from the query API and the profile."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalframe.functions.numbers import round_half_even
from vitalframe.operators.frequency import distribution
from vitalframe.operators.profile import analysis_columns
from vitalframe.plans.api import yearly_counts


def dataset_overview(tables: dict[str, DataFrame]) -> DataFrame:
    """``(dataset, n_rows, n_fields, first_fields, n_years, first_year, last_year)``.

    Every table is read once, its year column only; field lists come from the schema.
    """
    union, *rest = [
        df.select(F.lit(d).alias("dataset"), F.col("_year").cast("int").alias("_year"))
        for d, df in tables.items()
    ]
    for part in rest:
        union = union.union(part)
    # Counting per year first keeps a dominant dataset from landing in one task.
    per_year = union.groupBy("dataset", "_year").agg(F.count("*").alias("n"))
    counts = per_year.groupBy("dataset").agg(
        F.sum("n").alias("n_rows"),
        F.count("_year").alias("n_years"),
        F.min("_year").alias("first_year"),
        F.max("_year").alias("last_year"),
    )
    fields = [
        (d, len(analysis_columns(df)), ", ".join(analysis_columns(df)[:15]))
        for d, df in tables.items()
    ]
    spark = next(iter(tables.values())).sparkSession
    listed = spark.createDataFrame(fields, "dataset string, n_fields int, first_fields string")
    return listed.join(counts, "dataset").select(
        "dataset", "n_rows", "n_fields", "first_fields", "n_years", "first_year", "last_year"
    )


def loaded_share(loaded: DataFrame, stored: DataFrame) -> DataFrame:
    """``(n_loaded, n_stored, pct)`` of a loaded subset in the stored table."""
    total = stored.agg(F.count("*")).scalar()
    counts = loaded.agg(F.count("*").alias("n_loaded")).withColumn("n_stored", total)
    return counts.withColumn("pct", round_half_even(F.col("n_loaded") / F.col("n_stored") * 100, 1))


def temporal_overview(df: DataFrame, month: str = "mesocu") -> tuple[DataFrame, DataFrame]:
    """Counts per year and counts per month label."""
    return yearly_counts(df), distribution(df, month)
