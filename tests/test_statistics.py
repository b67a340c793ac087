import math
import random

import pytest
from helpers import rows
from pyspark.sql import functions as F

from vitalframe.operators import association, counts, crosstab, normality, outliers, profile


def cells(spark, table):
    data = [(f"r{i}", f"c{j}", n) for i, line in enumerate(table) for j, n in enumerate(line) if n]
    return spark.createDataFrame(data, "r string, c string, n long")


@pytest.mark.parametrize(
    "table,statistic,dof,p",
    [
        ([[7121, 65536], [5075, 90926]], 1255.768, 1, 4.6305e-275),
        ([[10, 20, 0], [5, 5, 10]], 19.4444, 2, 5.9937e-5),
    ],
)
def test_chi2_golden(spark, table, statistic, dof, p):
    row = association.chi2_independence(cells(spark, table), "r", "c").first()
    assert row["statistic"] == pytest.approx(statistic, abs=1e-3)
    assert row["dof"] == dof
    assert row["p_value"] == pytest.approx(p, rel=1e-3)
    assert row["neg_log10_p"] == pytest.approx(-math.log10(p), rel=1e-4)
    assert row["reject"] is True


def test_chi2_ignores_null_keys(spark):
    base = cells(spark, [[10, 20, 0], [5, 5, 10]])
    more = base.union(spark.createDataFrame([(None, "c0", 7)], base.schema))
    assert association.chi2_statistic(more, "r", "c").first()["statistic"] == pytest.approx(19.4444, abs=1e-3)


def test_chi2_zero_cell_with_continuity(spark):
    # All four deviations are 10/3; corrected statistic by hand.
    row = association.chi2_statistic(cells(spark, [[10, 0], [5, 15]]), "r", "c").first()
    expected = [5.0, 5.0, 10.0, 10.0]
    assert row["statistic"] == pytest.approx(sum(4.5**2 / e for e in expected))


def test_chi2_tail_is_accurate_far_out(spark):
    df = spark.createDataFrame([(10_000.0, 1), (3.84145882, 1), (0.0, 3), (50.0, 50)], "x double, k int")
    got = df.select(association.chi2_tail(F.col("x"), F.col("k")).alias("t")).select("t.*").collect()
    assert got[0]["p_value"] == 0.0
    assert got[0]["neg_log10_p"] == pytest.approx(2173.57, abs=0.05)
    assert got[1]["p_value"] == pytest.approx(0.05, rel=1e-6)
    assert got[2]["p_value"] == 1.0
    assert got[3]["p_value"] == pytest.approx(0.4734, abs=2e-4)


def test_proportion_golden(spark):
    df = spark.range(25064).select((F.col("id") < 14911).alias("hit"))
    row = association.proportion_test(df, F.col("hit")).first()
    assert row["statistic"] == pytest.approx(30.0538, abs=1e-4)
    assert row["reject"] is True
    assert row["neg_log10_p"] > 190


def test_shares_golden(spark):
    df = spark.range(25064).select((F.col("id") < 21411).alias("man"), (F.col("id") < 14911).alias("young"))
    men = association.share_within(df, F.col("man")).first()["share"]
    young = association.share_within(df, F.col("young"), F.col("man")).first()["share"]
    assert round(men * 100, 1) == 85.4
    assert round(young * 100, 1) == 69.6


def kruskal_frame(spark):
    groups = {"a": [1, 2, 2, 4], "b": [2, 5, 6], "c": [7, 8, 8]}
    data = [(g, float(x)) for g, xs in groups.items() for x in xs]
    return spark.createDataFrame([*data, ("a", None), ("other", 1.0)], "g string, x double")


def test_kruskal_golden(spark):
    row = association.kruskal_wallis(kruskal_frame(spark), "g", "x", ["a", "b", "c", "absent"]).first()
    assert (row["n"], row["dof"]) == (10, 2)
    assert row["statistic"] == pytest.approx(6.95625, abs=1e-5)
    assert row["p_value"] == pytest.approx(0.030865, abs=1e-6)


def test_kruskal_survives_monotone_maps(spark):
    df = kruskal_frame(spark)
    base = association.kruskal_statistic(df, "g", "x", ["a", "b", "c"]).first()["statistic"]
    mapped = df.withColumn("x", F.exp("x"))
    assert association.kruskal_statistic(mapped, "g", "x", ["a", "b", "c"]).first()["statistic"] == pytest.approx(base)


def test_running_totals_against_brute_force(spark):
    rnd = random.Random(7)
    # A third of all rows share one value, and one group holds most rows.
    data = [("hot" if rnd.random() < 0.7 else f"g{rnd.randrange(4)}", 5.0 if rnd.random() < 0.33 else round(rnd.gauss(0, 50), 1)) for _ in range(4000)]
    df = spark.createDataFrame(data, "g string, v double")
    got = counts.running_totals(counts.value_counts(df, "v", ["g"]), "v", ["g"]).collect()
    for r in got:
        same = [v for g, v in data if g == r["g"]]
        assert r["total"] == len(same)
        assert r["before"] == sum(v < r["v"] for v in same)
        assert r["n"] == sum(v == r["v"] for v in same)
    assert len(got) == len(set(data))


@pytest.mark.parametrize("slices", [2, 32, 256])
def test_quantiles_against_interpolation(spark, slices):
    rnd = random.Random(slices)
    data = [(f"g{i % 3}", rnd.choice([1.0, 2.0, rnd.random() * 100])) for i in range(1001)]
    df = spark.createDataFrame(data, "g string, value double")
    probs = {"a": 0.0, "b": 0.1, "c": 0.5, "d": 0.999, "e": 1.0}
    vc = counts.value_counts(df, "value", ["g"])
    got = counts.quantiles_of_counts(vc, probs, ["g"], slices=slices).collect()
    for r in got:
        xs = sorted(v for g, v in data if g == r["g"])
        for name, p in probs.items():
            h = (len(xs) - 1) * p
            lo = int(h)
            hi = min(lo + 1, len(xs) - 1)
            assert r[name] == pytest.approx(xs[lo] + (h - lo) * (xs[hi] - xs[lo]))


def test_small_quantiles(spark):
    df = spark.createDataFrame([(1.0,), (2.0,)], "x double")
    row = counts.exact_quantiles(df, ["x"], {"a": 0.25, "b": 0.5, "c": 0.75}).first()
    assert (row["a"], row["b"], row["c"]) == (1.25, 1.5, 1.75)


def test_shape_golden(spark):
    df = spark.createDataFrame([(float(x), 5.0) for x in (1, 2, 2, 4, 10, 10)], "x double, flat double")
    got = {r["column"]: r for r in profile.numeric_shape(df, ["x", "flat"]).collect()}
    assert got["x"]["skew"] == pytest.approx(0.744538, abs=1e-6)
    assert got["x"]["kurtosis"] == pytest.approx(-1.944759, abs=1e-6)
    assert (got["x"]["median"], got["x"]["mode"]) == (3.0, 2.0)
    assert (got["flat"]["skew"], got["flat"]["kurtosis"], got["flat"]["iqr"]) == (0.0, 0.0, 0.0)


def test_outlier_limits_and_flat_columns(spark):
    values = [35.0, 35.0, 78.0, 78.0, 200.0, -40.0, 50.0, 60.0]
    df = spark.createDataFrame([(v, 5.0) for v in values], "x double, flat double")
    got = outliers.iqr_outliers(df, ["x", "flat"]).collect()
    assert [r["column"] for r in got] == ["x"]
    assert got[0]["lower"] == pytest.approx(35 - 1.5 * 43)
    assert got[0]["upper"] == pytest.approx(78 + 1.5 * 43)
    assert got[0]["n_outliers"] == 2


def test_shapiro_known_samples(spark):
    weights = [148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236]
    ten = list(range(1, 11))
    data = [(float(w), float(ten[i]) if i < 10 else None, 1.0) for i, w in enumerate(weights)]
    df = spark.createDataFrame(data, "weight double, ten double, flat double")
    got = {r["column"]: r for r in normality.shapiro_wilk(df, ["weight", "ten", "flat"]).collect()}
    assert got["weight"]["w"] == pytest.approx(0.78881, abs=1e-4)
    assert got["weight"]["p_value"] == pytest.approx(0.006704, abs=1e-4)
    assert got["ten"]["w"] == pytest.approx(0.97016, abs=1e-4)
    assert got["ten"]["p_value"] == pytest.approx(0.8924, abs=1e-3)
    assert got["flat"]["w"] is None


def test_correlation_is_pairwise_complete(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0, None), (2.0, 4.0, 1.0), (3.0, 6.0, 0.0), (4.0, 8.0, None)], "a double, b double, c double"
    )
    got = {(r["a"], r["b"]): r["r"] for r in association.correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert len(got) == 9
    assert got[("a", "b")] == pytest.approx(1.0)
    assert got[("c", "a")] == got[("a", "c")] == pytest.approx(-1.0)


def test_crosstab_completes_the_grid(spark):
    df = spark.createDataFrame([("x", "p"), ("x", "p"), ("y", "q"), (None, "p"), ("x", None)], "r string, c string")
    assert rows(crosstab.crosstab_counts(df, "r", "c"), "r", "c", "n") == [
        ("x", "p", 2), ("x", "q", 0), ("y", "p", 0), ("y", "q", 1),
    ]
    shares = crosstab.crosstab_percent(df, "r", "c").groupBy("r").agg(F.sum("pct").alias("s"))
    assert all(r["s"] == pytest.approx(100) for r in shares.collect())


def test_modes(spark):
    df = spark.createDataFrame(
        [(1, "b", None), (1, "a", None), (1, "b", None), (1, "a", None), (2, None, "z")], "k int, s string, t string"
    )
    assert rows(counts.mode_by(df, "k", ["s", "t"])) == [(1, "a", "N/A"), (2, "N/A", "z")]
