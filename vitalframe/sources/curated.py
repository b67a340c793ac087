"""Curated Parquet: one table per dataset, partitioned by year, and SQL views over it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalframe import specs
from vitalframe.sources.landing import list_files
from vitalframe.sources.scratch import materialise

COMPRESSION = "zstd"


def write_curated(df: DataFrame, root: str, dataset: str, undated: Sequence[str] = ()) -> str:
    """Replace the years present in ``df`` and leave other years alone.

    Each vintage has one year, so every task writes one partition and no shuffle is needed. ``undated``
    names the files in ``df`` without a year: they share a partition with those stored before, which stay.
    """
    path = f"{root.rstrip('/')}/{dataset}"
    if undated and has_data(df.sparkSession, root, dataset):
        stored = read_curated(df.sparkSession, root, dataset).where("_year IS NULL")
        others = stored.where(~F.col("_source_file").isin(*undated))
        df = df.unionByName(materialise(others, "undated"))
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", COMPRESSION)
        .partitionBy("_year")
        .parquet(path)
    )
    return path


def read_curated(spark: SparkSession, root: str, dataset: str) -> DataFrame:
    """All years of a dataset by column name, with the declared types."""
    schema = specs.canonical_schema(dataset)
    return spark.read.schema(schema).parquet(f"{root.rstrip('/')}/{dataset}").select(*schema.names)


def newest_files(spark: SparkSession, root: str, dataset: str, years: Sequence[int]) -> dict[int, str]:
    """Year -> last name of the files stored for it, of these years only; a row per year reaches the driver."""
    if not years or not has_data(spark, root, dataset):
        return {}
    dated = read_curated(spark, root, dataset).where(F.col("_year").isin(*years))
    return dict(dated.groupBy("_year").agg(F.max("_source_file")).collect())


def has_data(spark: SparkSession, root: str, dataset: str) -> bool:
    """Whether the dataset's folder holds Parquet files; looks at one footer at most."""
    try:
        spark.read.parquet(f"{root.rstrip('/')}/{dataset}")
    except AnalysisException:
        return False
    return True


def register_views(spark: SparkSession, root: str) -> list[str]:
    """One SQL view per dataset that has files; returns their names."""
    present = [d for d in specs.datasets() if has_data(spark, root, d)]
    for dataset in present:
        read_curated(spark, root, dataset).createOrReplaceTempView(dataset)
    return present


def storage_inventory(spark: SparkSession, root: str) -> DataFrame:
    """``(dataset, n_files, mb)`` of the curated Parquet files."""
    files = list_files(spark, root).where(F.col("path").endswith(".parquet") & F.col("path").contains("/_year="))
    dataset = F.regexp_extract("path", r"/([^/]+)/_year=[^/]*/[^/]+$", 1)
    return files.groupBy(dataset.alias("dataset")).agg(
        F.count("*").alias("n_files"), (F.sum("length") / (1024 * 1024)).alias("mb")
    )
