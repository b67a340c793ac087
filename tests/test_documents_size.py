"""Stored documents repeat every field name in every row; their files must not grow with that."""

import json

from pyspark.sql import functions as F

from vitalframe.sources import documents


def test_documents_are_stored_compressed(spark, tmp_path):
    empty = [F.lit(None).cast("string").alias(f"a_field_without_values_{i}") for i in range(40)]
    wide = spark.range(5_000).coalesce(1).select("id", *empty)
    root = tmp_path / "d"
    assert documents.insert_documents({"c": wide}, str(root)) == 5_000
    values = [r["value"] for r in documents.read_documents(spark, str(root)).collect()]
    assert sorted(json.loads(v)["id"] for v in values) == list(range(5_000)) and all(len(json.loads(v)) == 41 for v in values)
    stored = sum(p.stat().st_size for p in (root / "collection=c").iterdir())
    assert stored * 20 < sum(len(v) for v in values)
    assert documents.collection_stats(spark, str(root)).first()["n_documents"] == 5_000
