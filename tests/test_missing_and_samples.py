"""NaN as missing, decimals as numbers, and samples that are exact and stay partitioned."""

import math

import pytest
from helpers import rows
from pyspark.sql import functions as F

from vitalframe.operators import charts, profile, sampling

NAN = math.nan


@pytest.fixture(scope="module")
def holed(spark):
    data = [(NAN, "a"), (1.0, "b"), (2.0, None), (None, "b"), (4.0, "c"), (NAN, "c")]
    return spark.createDataFrame(data, "x double, c string").repartition(2)


def test_profiles_take_nan_as_missing(holed):
    found = {r["column"]: (r["n_unique"], r["n_null"], r["pct_null"]) for r in profile.variable_profile(holed).collect()}
    assert found == {"x": (3, 3, 50.0), "c": (3, 1, 16.7)}
    quick = {r["column"]: (r["n_unique"], r["n_null"]) for r in profile.variable_profile(holed, approx=True).collect()}
    assert quick == {"x": (3, 3), "c": (3, 1)}
    assert rows(profile.missingness(holed), "column", "n_null") == [("c", 1), ("x", 3)]
    for approx in (False, True):
        r = profile.numeric_describe(holed, ["x"], approx).first()
        assert (r["n"], r["min"], r["max"]) == (3, 1.0, 4.0) and r["mean"] == pytest.approx(7 / 3) and r["q50"] == 2.0
    assert profile.numeric_shape(holed, ["x"]).first()["median"] == 2.0
    s = profile.summarize(holed, ["x"]).first()
    assert (s["min"], s["max"], s["approx_unique"], s["null_percentage"]) == ("1.0", "4.0", 3, 50.0) and s["avg"] == pytest.approx(7 / 3)


def test_charts_take_nan_as_missing(holed):
    bins = charts.histogram(holed, "x", 3).orderBy("bin").collect()
    assert [(r["lo"], r["hi"], r["n"]) for r in bins] == [(1.0, 2.0, 1), (2.0, 3.0, 1), (3.0, 4.0, 1)]


def test_decimals_are_numbers(spark):
    df = spark.range(30).selectExpr("CAST(id AS DECIMAL(12, 2)) AS d", "CAST(id % 3 AS STRING) AS s")
    found = profile.variable_profile(df)
    assert rows(profile.select_columns(found, "numeric"), "column") == [("d",)]
    assert rows(profile.select_columns(found, "categorical"), "column") == [("s",)]
    s = profile.summarize(df, ["d"]).first()
    assert s["avg"] == 14.5 and s["q50"] == 14.0 and s["std"] == pytest.approx(math.sqrt(30 * 31 / 12))


@pytest.mark.parametrize("n", [0, 1, 7, 5000, 60_000, 70_000])
def test_samples_are_the_smallest_scores(spark, n):
    df = spark.range(0, 60_000, 1, 12)
    got = sampling.sample_rows(df, n, key=["id"])
    scored = df.withColumn("s", sampling.sample_score(42, ["id"]))
    want = sorted((r["s"], r["id"]) for r in scored.collect())[:n]
    assert sorted(r["id"] for r in got.collect()) == sorted(i for _, i in want)
    if n >= 5000:
        assert got.select(F.spark_partition_id().alias("p")).distinct().count() == 12
    assert "Sort" not in got._jdf.queryExecution().executedPlan().toString()


def test_samples_of_equal_keys_and_without_keys(spark):
    same = spark.range(50_000).select(F.lit(1).alias("k"))
    assert sampling.sample_rows(same, 12_345, key=["k"]).count() == 12_345
    assert sampling.sample_rows(spark.range(0, 50_000, 1, 5), 20_000).count() == 20_000
    assert sampling.sample_rows(spark.range(10), 20).count() == 10 and sampling.sample_rows(spark.range(0), 5, key=["id"]).count() == 0


def test_density_curve_leaves_nan_out(spark):
    clean = [("a", float(x)) for x in (1, 2, 2, 5)]
    schema = "g string, x double"
    with_nan = spark.createDataFrame([*clean, ("a", NAN), ("a", None)], schema)
    same = charts.density_curve(spark.createDataFrame(clean, schema), "x", "g").orderBy("i").collect()
    found = charts.density_curve(with_nan, "x", "g").orderBy("i").collect()
    assert len(found) == 200
    assert all(abs(f.x - s.x) < 1e-12 and abs(f.density - s.density) < 1e-12 for f, s in zip(found, same))
