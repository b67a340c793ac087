import math

import pytest
from helpers import rows
from pyspark.sql import functions as F

from vitalframe.operators import decode

LABELS = {
    "SEXO": {1: "Masculino", 2: "Femenino"},
    "edadif": {999: "Ignorado"},
    "mix": {1: "a"},
    "empty": {9: "x"},
}


@pytest.fixture()
def coded(spark):
    return spark.createDataFrame(
        [(1.0, 34.0, 1.0, None), (2.0, 999.0, 1.0, None), (1.0, 70.0, 7.0, None), (None, None, 8.0, None)],
        "sexo double, edadif double, mix double, empty double",
    )


def test_ratio_per_column(coded):
    found = {r["column"]: r["ratio"] for r in decode.label_ratio(coded, LABELS).collect()}
    assert found["sexo"] == 1.0
    assert found["edadif"] == pytest.approx(1 / 3)
    assert found["mix"] == 0.5
    assert found["empty"] is None


def test_labels_decode_or_blank(coded):
    out = [tuple(r) for r in decode.apply_labels(coded, LABELS).collect()]
    assert out == [
        ("Masculino", 34.0, None, None),
        ("Femenino", None, None, None),
        ("Masculino", 70.0, 7.0, None),
        (None, None, 8.0, None),
    ]


def test_unlabelled_codes_stay_as_text(spark):
    df = spark.createDataFrame([(1.0,), (1.0,), (7.0,)], "c double")
    assert rows(decode.apply_labels(df, {"c": {1: "uno"}})) == [("7.0",), ("uno",), ("uno",)]


def test_long_dictionary_is_joined(spark):
    pairs = {i: f"n{i}" for i in range(decode.INLINE_LIMIT + 5)}
    df = spark.createDataFrame([(3.0, "a"), (99999.0, "b"), (None, "c"), (4.0, "d")], "c double, k string")
    out = decode.apply_labels(df, {"c": pairs})
    assert out.columns == ["c", "k"]
    assert rows(out) == [(None, "c"), ("99999.0", "b"), ("n3", "a"), ("n4", "d")]


def test_lookup_join_never_multiplies(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "v string")
    pairs = spark.createDataFrame([("a", "x"), ("a", "y")], "key string, value string")
    assert rows(decode.replace_by_join(df, "v", pairs)) == [(None,), ("b",), ("x",)]


@pytest.mark.parametrize("bad,expected", [(1, "double"), (2, "string")])
def test_coercion_is_strict_above_eighty_percent(spark, bad, expected):
    values = [str(i) for i in range(10 - bad)] + ["x"] * bad + [None]
    df = spark.createDataFrame([(v,) for v in values], "t string")
    assert dict(decode.coerce_numeric(df).dtypes)["t"] == expected


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(math.nan, 1), (2.0, 2), (None, 3)], "x double, i int")
    assert rows(decode.nan_to_null(df).orderBy("i"), "i", "x") == [(1, None), (2, 2.0), (3, None)]


def test_text_codes(spark):
    df = spark.createDataFrame([("A",), ("A",), ("N",)], "f string")
    assert rows(decode.apply_labels(df, {"f": {"A": "Activo"}})) == [("Activo",), ("Activo",), ("N",)]


def test_labels_with_quotes(spark):
    df = spark.createDataFrame([(1.0,)], "c double")
    text = "o'neil \\ \"x\""
    assert decode.apply_labels(df, {"c": {1: text}}).first()[0] == text
    assert df.select(F.lit(text)).first()[0] == text


def test_numbers_in_text_meet_numeric_labels(spark):
    """A code is the same code as text or number, however it is written; other texts match as they are."""
    df = spark.createDataFrame([("1",), ("1.0",), (" 01",), ("2",), ("x",), ("7",), (None,)], "c string")
    assert rows(decode.apply_labels(df, {"C": {1.0: "uno", "2": "dos", "x": "equis"}})) == [
        (None,), ("7",), ("dos",), ("equis",), ("uno",), ("uno",), ("uno",),
    ]
    sentinel = spark.createDataFrame([("99",), ("5",), ("6",), ("8",)], "c string")
    assert rows(decode.apply_labels(sentinel, {"c": {99.0: "Ignorado"}})) == [(None,), ("5",), ("6",), ("8",)]
    whole = spark.createDataFrame([(1,), (3,)], "c int")
    assert rows(decode.apply_labels(whole, {"c": {"1": "uno", "03": "tres"}})) == [("tres",), ("uno",)]


def test_nan_is_no_valid_value(spark):
    df = spark.createDataFrame([(1.0,), (math.nan,), (math.nan,), (None,)], "c double")
    assert tuple(decode.label_ratio(df, {"c": {1: "uno"}}).first()) == ("c", 1, 1, 1.0)


def shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_long_labels_do_not_shuffle_the_rows(spark):
    """1,500 labels from Python are broadcast, in the ratio as in the decoding, and sentinels match as well."""
    pairs = {i: f"n{i}" for i in range(1500)}
    df = spark.range(4000).select((F.col("id") % 1600).cast("double").alias("c"), F.col("id").cast("string").alias("t"))
    out = decode.decode_with_ratios(df, {"c": pairs, "t": pairs}, {"c": 0.9, "t": 0.1})
    assert shuffles(out) == 0
    got = {r["t"]: r["c"] for r in out.collect()}
    assert out.where("t IS NULL").count() == 1500 and got["1555"] == "1555.0" and got["1601"] == "n1"
    assert decode.label_ratio(df, {"c": pairs, "t": pairs}).select("n_labelled").collect() == [(3900,), (1500,)]


def test_large_lookup_splits_hot_codes(spark):
    """Beyond the broadcast limit every row still meets its code: hot, rare, unknown or missing."""
    code = F.when(F.col("id") % 3 == 0, F.lit("7")).when(F.col("id") % 5 == 0, F.lit(None)).otherwise(F.col("id").cast("string"))
    df = spark.range(6000).select(code.alias("v"), "id")
    pairs = spark.range(3000).selectExpr("id AS key", "concat('n', id) AS value")
    small, large = decode.replace_by_join(df, "v", pairs), decode.replace_by_join(df, "v", pairs, limit=0)
    assert shuffles(small) == 0 and rows(small) == rows(large) and large.columns == ["v", "id"]
    got = {r["id"]: r["v"] for r in large.collect()}
    assert (got[0], got[5], got[1], got[5999]) == ("n7", None, "n1", "5999")
