"""Rounds over ids write few files, however wide the shuffles are."""

from __future__ import annotations

from pathlib import Path

from vitalframe.llm import jaccard, spread


def test_rounds_of_near_copies_write_few_files(spark, monkeypatch):
    rows = [(i, " ".join(f"w{i // 4}x{j}" for j in range(40 + i % 4))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    files, kept = [], {m: m.materialise for m in (jaccard, spread)}

    def watched(module):
        def run(frame, name):
            out = kept[module](frame, name)
            files.append((name, len(out.inputFiles())))
            return out

        return run

    for module in kept:
        monkeypatch.setattr(module, "materialise", watched(module))
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "48")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = {r.doc_id: r.component_id for r in jaccard.near_copies(docs, 3, 90).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {i: i - i % 4 for i in range(400)}
    ids = [(name, n) for name, n in files if name not in ("profile", "texts")]
    assert len(ids) >= 8 and max(n for _, n in ids) <= 4
