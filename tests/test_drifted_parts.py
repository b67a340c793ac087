"""Part files of one vintage whose key types differ, with keys that don't fit the narrow types."""

from pyspark.sql import functions as F

SCHEMA = "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string"


def test_large_keys_are_kept(spark, monkeypatch):
    from suite import q_ingest

    keys = [1, 32_767, 32_768, 90_000, 2**31, None]
    data = [(i, k, s, "2-HIGH") for i, k in enumerate(keys) for s in ("F", "O", "P", None)]
    frame = spark.createDataFrame(data, SCHEMA)
    monkeypatch.setattr(q_ingest, "table", lambda *_: frame)
    got = q_ingest.drifted_parts(spark, "")
    assert dict(got.dtypes)["edadif"] == "double" and dict(got.dtypes)["sexo"] == "string"
    found = {(r["areag"], r["caudef"], r["edadif"], r["sexo"]): r["n"] for r in got.collect()}
    want = {}
    for _, k, s, priority in data:
        age = None if k is None else float(k) + (0.5 if s == "P" else 0)
        sex = None if k is None else ("x" if s == "P" else "") + str(k)
        row = (None if s == "F" else priority, s, age, sex)
        want[row] = want.get(row, 0) + 1
    assert found == want
    assert got.agg(F.sum("n")).first()[0] == len(data)
