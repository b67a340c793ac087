"""From raw documents to sharded training data: five stages, each written as Parquet and read by the next.

Each stage takes (spark, docs, sf_dir); all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitalframe.llm.decontaminate import find_leaks
from vitalframe.llm.jaccard import ARROW_ROWS, near_copies
from vitalframe.llm.mixing import mix
from vitalframe.llm.queries import OLD_SHARDS, id_remainder
from vitalframe.llm.sharding import reshard
from vitalframe.llm.toxicity import score_toxicity
from vitalframe.sources.scratch import materialise

#: Word shingles of this length, and this Jaccard in percent, make near copies.
SHINGLE, PERCENT = 5, 80
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Whole documents go through Python, also when a stage's rows are written: at most ARROW_ROWS at a time from here on.

    A smaller setting of the session stays.
    """
    if not 0 < int(spark.conf.get(BATCH_SETTING)) <= ARROW_ROWS:
        spark.conf.set(BATCH_SETTING, str(ARROW_ROWS))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents more likely toxic than not go."""
    small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = score_toxicity(docs, labels, fit=id_remainder(5).isin(1, 2, 3), calibrate=id_remainder(5) == 4)
    return scored.where("toxicity < 0.5").drop("toxicity")


def jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id; of rows with one id, one.

    Documents without words or without an id link with nothing and stay.
    """
    groups = near_copies(docs, SHINGLE, PERCENT)
    copies = groups.where("component_id < doc_id").select(F.col("doc_id").alias("_copy")).distinct()
    kept = docs.join(copies, docs.doc_id == copies._copy, "left_anti")
    first = Window.partitionBy("doc_id").orderBy(F.crc32("text"), "n_chars", "source", "lang")
    named = kept.where("doc_id IS NOT NULL").withColumn("_row", F.row_number().over(first)).where("_row = 1").drop("_row")
    return named.unionByName(kept.where("doc_id IS NULL"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark window go."""
    leaks = find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    hit = leaks.where("n_hit > 0").select(F.col("doc_id").alias("_hit")).distinct()
    return docs.join(hit, docs.doc_id == hit._hit, "left_anti")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training sequence: a row for every reading of at least half of a document, in the order of positions."""
    read = mix(docs, carry="doc").withColumn("p", F.explode("passes")).where("2 * p.words >= size")
    return read.orderBy("p.position", "doc_id").select("doc.*")


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Eight shards of near equal bytes, from six that the documents lie in; adds shard, slot and old_shard."""
    text = F.coalesce("text", F.lit(""))
    return reshard(docs, size=F.octet_length(text) + 1, group=F.xxhash64(text), old=F.pmod(F.xxhash64(text), F.lit(OLD_SHARDS)))


STAGES = [
    ("toxicity", toxicity),
    ("ngram_jaccard_join", jaccard),
    ("benchmark_decontamination", decontamination),
    ("curriculum_mixing", mixing),
    ("flow_sharding", sharding),
]

#: The stages fit models and hash, which SQL can't say; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
