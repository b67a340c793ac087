"""Stages of the pipeline keep few Python workers: no step beside the Arrow ones, and one of those in a task."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from vitalframe.llm import sharding, spread, toxicity
from vitalframe.llm.decontaminate import find_leaks


def _plan(frame) -> str:
    return frame._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("rows", [[], [(1, None, "a", 1 << 40), (2, 5, None, None)]])
def test_listed_rows_are_in_the_plan(spark, rows):
    got = spread.listed(spark, rows, "i int, j int, t string, n long")
    assert [tuple(r) for r in got.collect()] == rows
    assert got.dtypes == [("i", "int"), ("j", "int"), ("t", "string"), ("n", "bigint")]
    assert "LocalRelation" in _plan(got) and "RDD" not in _plan(got)


def test_plans_of_the_driver_take_no_workers_of_their_own(spark):
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.concat(F.lit("some words "), F.col("id") % 30).alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    scored = toxicity.score_toxicity(docs, labels, fit=F.col("doc_id") % 5 < 4, calibrate=F.col("doc_id") % 5 == 4)
    assert scored.count() == 40
    none = toxicity.score_toxicity(docs, labels.where("toxic > 1"), fit=F.col("doc_id") % 5 < 4, calibrate=F.col("doc_id") % 5 == 4)
    assert none.count() == 40 and none.where("toxicity > 0.5").count() == 0
    old = F.pmod(F.col("doc_id"), F.lit(6))
    dealt = sharding.reshard(docs, size=F.octet_length("text") + 1, group=F.xxhash64("text"), old=old)
    assert "ExistingRDD" not in _plan(dealt) and "LogicalRDD" not in _plan(dealt)
    assert dealt.count() == 40 and dealt.where("shard IS NULL").count() == 0


@pytest.mark.parametrize("block_bytes", [1 << 20, 40])
def test_texts_meet_python_once_a_block(spark, block_bytes):
    docs = spark.createDataFrame([(1, "One two THREE four"), (2, "five six"), (3, None)], "doc_id long, text string")
    bench = spark.createDataFrame([("x", "two three four"), ("y", "five six"), ("z", "seven eight nine"), ("w", "ten")], "item_id string, text string")
    leaks = find_leaks(docs, bench, k=3, block_bytes=block_bytes)
    assert _plan(leaks).count("MapInArrow") == 1
    got = {r.doc_id: (r.n_words, r.n_hit, list(r["items"]), r.clean) for r in leaks.collect()}
    assert got == {1: (4, 3, ["x"], "One "), 2: (2, 2, ["y"], ""), 3: (0, 0, [], None)}
