"""Many columns and many categories: correlations from Gram matrices, sparse contingency tables, densities by reach."""

import math

import numpy as np
import pandas as pd
import pytest
from helpers import rows
from pyspark.sql import functions as F

from vitalframe.operators import association, charts, crosstab, gram


def test_wide_correlations_agree_with_pandas(spark):
    """150 columns with NULL and NaN, a constant one, an empty one, and one far from zero."""
    rng = np.random.default_rng(7)
    x = rng.normal(size=(300, 150))
    x[:, 1] += x[:, 0]
    x[:, 2] = 1e9 + x[:, 0]
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:, 3], x[:, 4] = 5.1, np.nan
    names = [f"col {i}.x" for i in range(150)]
    frame = pd.DataFrame(x, columns=names)
    want = frame.corr(min_periods=2).to_numpy()
    there = frame.notna().to_numpy().astype(int)
    n = there.T @ there
    values = [[None if math.isnan(v) and i % 2 else float(v) for v in row] for i, row in enumerate(x)]
    df = spark.createDataFrame(values, ", ".join(f"`{c}` double" for c in names)).repartition(5)
    got = {(r.a, r.b): r for r in gram.wide_correlations(df, names).collect()}
    assert len(got) == 150 * 150
    for i, a in enumerate(names):
        for j, b in enumerate(names):
            r = got[a, b]
            assert r.n == n[i, j]
            if {3, 4} & {i, j}:
                assert r.r is None
            else:
                assert r.r == pytest.approx(want[i, j], abs=1e-6)
    ranked = gram.wide_ranking(df.select(*[f"`{c}`" for c in names[:4]]), names[:4]).collect()
    assert len(ranked) == 6 and [ranked[0].a, ranked[0].b] == [names[0], names[2]]
    assert gram.wide_correlations(df.where("false"), names).count() == 0


def test_wide_correlations_of_parts_without_common_rows(spark):
    """A pair that only one task, and one that no task, holds together."""
    values = [(0, 1.0, 2.0, None), (0, 2.0, 4.5, None), (0, 3.0, 5.0, None), (1, 7.0, None, 1.0), (1, 9.0, None, 4.0)]
    df = spark.createDataFrame(values, "k int, a double, b double, c double").repartition(4, "k")
    got = {(r.a, r.b): (r.n, r.r) for r in gram.wide_correlations(df, ["a", "b", "c"]).collect()}
    assert got["a", "b"] == (3, pytest.approx(np.corrcoef([1, 2, 3], [2, 4.5, 5])[0, 1]))
    assert got["a", "c"] == (2, pytest.approx(1.0)) and got["b", "c"] == (0, None)


def test_contingency_holds_observed_cells_only(spark):
    cells = [("x", "p")] * 3 + [("x", "q"), ("y", "q"), ("z", "p"), (None, "p"), ("x", None)]
    df = spark.createDataFrame(cells, "r string, c string")
    got = rows(crosstab.contingency(df, "r", "c"), "r", "c", "n", "row_total", "col_total", "row_pct", "expected")
    assert [g[:5] for g in got] == [("x", "p", 3, 4, 4), ("x", "q", 1, 4, 2), ("y", "q", 1, 1, 2), ("z", "p", 1, 1, 4)]
    assert [g[5] for g in got] == [75.0, 25.0, 100.0, 100.0]
    assert [g[6] for g in got] == pytest.approx([16 / 6, 8 / 6, 2 / 6, 4 / 6])
    assert crosstab.contingency(df.where("false"), "r", "c").count() == 0
    listed = rows(crosstab.listed_cells(df, "r", "c", ["q", "none", "q"]), "r", "c", "n")
    assert listed == [("x", "none", 0), ("x", "q", 1), ("y", "none", 0), ("y", "q", 1), ("z", "none", 0), ("z", "q", 0)]


def test_chi2_near_independence_at_large_counts(spark):
    """Counts of 10^12 that are independent but for one: the difference of large sums would lose the statistic."""
    n = 10**12
    df = spark.createDataFrame([("a", "x", n), ("a", "y", n), ("a", "z", n), ("b", "x", n), ("b", "y", n), ("b", "z", n + 10**6)], "r string, c string, n long")
    got = association.chi2_statistic(df, "r", "c").first()
    table = np.array([[n, n, n], [n, n, n + 10**6]], dtype=float)
    expected = table.sum(1, keepdims=True) * table.sum(0) / table.sum()
    assert got["dof"] == 2 and got["statistic"] == pytest.approx(((table - expected) ** 2 / expected).sum(), rel=1e-3)


def test_density_far_from_all_values(spark):
    """Two clumps far apart: grid points between them are out of reach, zero, and there."""
    values = [("g", i % 7 / 1000) for i in range(5000)] + [("g", 1000.0 + i % 7 / 1000) for i in range(5)]
    df = spark.createDataFrame(values, "g string, x double")
    got = charts.density_curve(df, "x", "g", grid=400).orderBy("i").collect()
    x = np.array([v for _, v in values])
    h = x.std(ddof=1) * len(x) ** -0.2
    assert [r["i"] for r in got] == list(range(400))
    want = [np.exp(-(((r["x"] - x) / h) ** 2) / 2).sum() / (len(x) * h * math.sqrt(2 * math.pi)) for r in got]
    assert [r["density"] for r in got] == pytest.approx(want, rel=1e-9, abs=1e-300)
    assert any(r["density"] == 0 for r in got)
