"""Registered corpus queries against their SQL, and the pipeline against its own operators' promises."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tools.check import check, database
from vitalframe.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="generated tables are not here")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    state, note = check(spark, database(SF_DIR), name, SF_DIR)
    assert state == ("OK" if name in ORACLES else "ROWS"), note


def test_language_and_scoring_hold_out(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    named = QUERIES["op2_language_bloom"](spark, SF_DIR).join(docs, "doc_id").where("held_out AND lang IS NOT NULL")
    assert named.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.95


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    steps = [docs]
    for name, stage in corpus_pipeline.STAGES:
        steps.append(corpus_pipeline.materialise(stage(spark, steps[-1], SF_DIR), name).cache())
    assert all(x.columns == docs.columns for x in steps[:-1])
    ids = [{r.doc_id for r in x.select("doc_id").collect()} for x in steps]
    assert all(b <= a for a, b in zip(ids, ids[1:])) and len(ids[3]) < len(ids[0])
    again = corpus_pipeline.jaccard(spark, steps[2], SF_DIR)
    assert again.count() == steps[2].count()
    assert corpus_pipeline.decontamination(spark, steps[3], SF_DIR).count() == steps[3].count()
    size = steps[-1].groupBy("shard").agg(F.sum(F.octet_length("text") + 1).alias("b")).collect()
    assert len(size) == 8
    assert corpus_pipeline.run(spark, SF_DIR).count() == steps[-1].count()
