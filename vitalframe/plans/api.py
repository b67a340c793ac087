"""Query interface over the curated tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalframe import specs
from vitalframe.operators.counts import count_by
from vitalframe.operators.profile import analysis_columns, summarize
from vitalframe.operators.sampling import sample_rows
from vitalframe.sources import curated


def select_rows(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    where: str | None = None,
    sample_n: int = 0,
    seed: int = 42,
    key: Sequence[str] = (),
    sample_before_filter: bool = True,
) -> DataFrame:
    """Column subset, SQL predicate and fixed-size sample.

    By default the sample is drawn before the predicate applies, so fewer than ``sample_n`` rows
    may remain.
    """
    if sample_n > 0 and sample_before_filter:
        df = sample_rows(df, sample_n, seed, key)
    if where:
        df = df.where(where)
    if sample_n > 0 and not sample_before_filter:
        df = sample_rows(df, sample_n, seed, key)
    return df.selectExpr(*columns) if columns else df


def yearly_counts(df: DataFrame) -> DataFrame:
    """Rows per year, in order."""
    return count_by(df, "_year").orderBy("_year")


def distinct_years(df: DataFrame) -> DataFrame:
    return df.select("_year").where(F.col("_year").isNotNull()).distinct().orderBy("_year")


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``(dataset, n)`` with a total row whose dataset is NULL; one job for all tables."""
    union, *rest = [df.select(F.lit(name).alias("dataset")) for name, df in tables.items()]
    for part in rest:
        union = union.union(part)
    return union.rollup("dataset").agg(F.count("*").alias("n"))


class Registry:
    """Curated datasets under one root. Results stay DataFrames until asked for otherwise."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root
        self.views = curated.register_views(spark, root)

    def table(self, dataset: str) -> DataFrame:
        return curated.read_curated(self.spark, self.root, dataset)

    def load(self, dataset: str, **options) -> DataFrame:
        """See :func:`select_rows` for the options."""
        return select_rows(self.table(dataset), **options)

    def sample(self, dataset: str, n: int = 1000, seed: int = 42) -> DataFrame:
        return sample_rows(self.table(dataset), n, seed)

    def sql(self, text: str) -> DataFrame:
        """Any SQL over the registered views."""
        self.views = curated.register_views(self.spark, self.root)
        return self.spark.sql(text)

    def yearly_counts(self, dataset: str) -> DataFrame:
        return yearly_counts(self.table(dataset))

    def distinct_years(self, dataset: str) -> DataFrame:
        return distinct_years(self.table(dataset))

    def list_datasets(self) -> list[str]:
        self.views = curated.register_views(self.spark, self.root)
        return list(self.views)

    def table_counts(self) -> DataFrame:
        return table_counts({d: self.table(d) for d in self.list_datasets()})

    def describe(self, dataset: str) -> DataFrame:
        return summarize(self.table(dataset))

    def fields(self, dataset: str, first: int = 15) -> list[str]:
        """First non-lineage field names, from the schema alone."""
        return analysis_columns(self.table(dataset))[:first]

    def column_labels(self, dataset: str) -> dict[str, str]:
        return specs.column_descriptions(dataset)

    def storage(self) -> DataFrame:
        return curated.storage_inventory(self.spark, self.root)

    @staticmethod
    def to_pandas(df: DataFrame):
        """Hand-off of a small result as pandas."""
        return df.toPandas()

    @staticmethod
    def to_arrow(df: DataFrame):
        """Hand-off of a small result as an Arrow table."""
        return df.toArrow()
