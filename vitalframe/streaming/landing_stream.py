"""Load new vintages as they land, with Structured Streaming.

The stream watches file names only. Each micro-batch plans its new files one by one, so columns
may differ between vintages, and writes them with the same steps as a full load.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vitalframe import specs
from vitalframe.functions.text import year_from_name
from vitalframe.plans.etl import SUPERSEDED, FileLabels, LoadResult, Vintage, finish, load_side_by_side, quarantine_status
from vitalframe.sources import curated, landing
from vitalframe.sources.landing import vintage_name


def load_vintages(
    spark: SparkSession,
    landing_dir: str,
    names: list[str],
    curated_dir: str,
    labels: FileLabels | None = None,
) -> LoadResult:
    """Classify, harmonise and write the named vintages; every one leaves a row in the status table.

    Unreadable files, unknown ones and copies are held. So is a vintage of a year that a file later by name is
    stored for (superseded): the batches don't decide who wins.
    """
    plans = landing.in_parallel(lambda name: landing.probe(spark, landing_dir, name), names)
    lo, hi = specs.YEAR_RANGE
    failed = F.col("error").isNotNull()
    inventory = (
        spark.createDataFrame(plans, landing.PLAN_SCHEMA)
        .withColumn("is_duplicate", landing.is_copy(F.col("filename")))
        .withColumn("dataset_type", F.when(failed, specs.ERROR_DATASET).otherwise(landing.classify(F.col("columns"))))
        .withColumn("year", year_from_name(F.col("filename"), lo, hi))
    )
    vintages = [
        Vintage(r["filename"], r["filepath"], r["dataset_type"], r["year"], r["column_labels"])
        for r in landing.loadable_files(inventory).orderBy("filename").collect()
    ]

    def dated(v: Vintage) -> None:
        if v.year is None:
            v.year, v.reason = landing.attempt(lambda: landing.year_from_data(landing.read_vintage(spark, v.filepath)))

    landing.in_parallel(dated, vintages)
    readable = [v for v in vintages if v.reason is None]
    # The last file by name wins when two cover the same dataset and year; undated ones all stay.
    latest = {(v.dataset, v.year or v.filename): v for v in readable}
    stored = {
        d: curated.newest_files(spark, curated_dir, d, sorted({v.year for v in readable if v.dataset == d and v.year}))
        for d in {v.dataset for v in readable}
    }
    for v in readable:
        if latest[(v.dataset, v.year or v.filename)] is not v or v.filename < stored[v.dataset].get(v.year, ""):
            v.status = SUPERSEDED
    load_side_by_side(spark, [v for v in readable if v.status != SUPERSEDED], labels or {}, curated_dir)
    return finish(spark, curated_dir, vintages, quarantine_status(inventory))


def stream_landing(
    spark: SparkSession,
    landing_dir: str,
    curated_dir: str,
    checkpoint_dir: str,
    labels: FileLabels | None = None,
    files_per_batch: int = 1_000,
) -> StreamingQuery:
    """Start a stream that loads everything present and stops (``availableNow``).

    A vintage split over two batches is loaded twice; a load replaces its year, so the second one
    leaves the same result. Of two vintages of a year the last by name stays, whatever batch it is in.
    """

    def load_batch(batch: DataFrame, _: int) -> None:
        names = batch.select(vintage_name(F.col("path"), landing_dir).alias("name")).distinct()
        found = sorted(r["name"] for r in names.collect())
        if found:
            load_vintages(spark, landing_dir, found, curated_dir, labels)

    listing = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(landing_dir)
        .select("path")
    )
    return (
        listing.writeStream.foreachBatch(load_batch)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
