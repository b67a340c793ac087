"""Document store output: JSON documents per collection and a keyed metadata table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from vitalframe.operators.decode import nan_to_null

#: Every document repeats all field names, so files are compressed; readers go by their ending.
COMPRESSION = "gzip"


def to_documents(df: DataFrame, collection: str) -> DataFrame:
    """``(value, collection)``: one JSON text per row, NaN written as null, all fields kept."""
    clean = nan_to_null(df)
    document = F.to_json(F.struct(*clean.columns), {"ignoreNullFields": "false"})
    return clean.select(document.alias("value"), F.lit(collection).alias("collection"))


def insert_documents(
    frames: Mapping[str, DataFrame], root: str, reload: bool = False, batch_size: int | None = None
) -> int:
    """Write all collections in one job and return the number of documents.

    ``reload`` drops every stored collection first. ``batch_size`` caps the documents per file, and such files stay
    plain text for tools that take batches; leave it unset on large data, so that files keep a useful size and are compressed.
    """
    union, *rest = [to_documents(df, name) for name, df in frames.items()]
    for part in rest:
        union = union.union(part)
    written = Observation("documents")
    writer = union.observe(written, F.count(F.lit(1)).alias("n")).write.option("compression", "none" if batch_size else COMPRESSION)
    if batch_size:
        writer = writer.option("maxRecordsPerFile", batch_size)
    writer.mode("overwrite" if reload else "append").option(
        "partitionOverwriteMode", "static"
    ).partitionBy("collection").text(root)
    return written.get["n"]


def read_documents(spark: SparkSession, root: str) -> DataFrame:
    """``(value, collection)`` of every stored document."""
    return spark.read.text(root)


def collection_stats(spark: SparkSession, root: str) -> DataFrame:
    """``(collection, n_documents, fields)``; fields as in one document of the collection."""
    return (
        read_documents(spark, root)
        .groupBy("collection")
        .agg(F.count("*").alias("n_documents"), F.first("value").alias("_doc"))
        .select("collection", "n_documents", F.json_object_keys("_doc").alias("fields"))
    )


def save_metadata(spark: SparkSession, path: str, labels: Mapping[str, Mapping[str, str]]) -> None:
    """Insert or replace the column labels of each dataset.

    The table is partitioned by its key, so an upsert overwrites just the named partitions.
    """
    rows = [(d, dict(pairs)) for d, pairs in labels.items()]
    table = spark.createDataFrame(rows, "dataset_type string, column_labels map<string,string>")
    (
        table.coalesce(1)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("dataset_type")
        .parquet(path)
    )


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(
        "column_labels map<string,string>, dataset_type string"
    ).parquet(path)
