"""Only texts of documents that have candidates are shuffled."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitalframe.llm import jaccard, spread


def test_among_keeps_all_wanted_rows_and_few_others(spark, monkeypatch):
    df = spark.range(-3000, 3000).select(F.col("id").alias("k"), F.col("id").cast("string").alias("t"))
    df = df.union(spark.sql("SELECT CAST(NULL AS BIGINT), 'none'")).union(df.where("k = 7"))
    wanted = spark.range(-1500, 1500).where("id % 50 = 7").select(F.col("id").cast("int").alias("x"))
    keys = [r.x for r in wanted.collect()]
    got = [(r.k, r.t) for r in spread.among(df, "k", wanted).collect()]
    assert sorted(t for t in got if t[0] in keys) == sorted([*[(k, str(k)) for k in keys], (7, "7")])
    assert len(got) < len(keys) + 30
    monkeypatch.setattr(spread, "WANTED_BITS", 1 << 4)  # far too few bits: others pass, none is lost
    monkeypatch.setattr(spread, "PIECE_BITS", 1 << 2)
    assert {r.k for r in spread.among(df, "k", wanted).collect()} >= set(keys)
    assert spread.among(df, "k", wanted.limit(0)).count() == 0


def test_texts_without_candidates_are_not_shuffled(spark, monkeypatch):
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(40))) for i in range(300)]
    rows += [(1000 + i, f"{rows[i][1]} end") for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    plans, kept = [], jaccard.materialise

    def watched(frame, name):
        if name == "texts":
            plans.append(frame._jdf.queryExecution().optimizedPlan().toString())
        return kept(frame, name)

    monkeypatch.setattr(jaccard, "materialise", watched)
    got = {r.doc_id: r.component_id for r in jaccard.near_copies(docs, 3, 90).collect()}
    assert got == {i: i for i in range(300)} | {1000 + i: i for i in range(4)}
    assert plans and all("bitmap_construct_agg" in p for p in plans)
