"""A sweep of k moves the starts of all its ks in the same passes, with what each fit finds alone."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from suite import q_cluster
from vitalframe.operators import clustering, kmeans_search


@pytest.fixture()
def seen(monkeypatch):
    """Models of each pass."""
    counts, statistics = [], kmeans_search._statistics
    monkeypatch.setattr(kmeans_search, "_statistics", lambda p, models, w: (counts.append(len(models)), statistics(p, models, w))[1])
    return counts


@pytest.fixture(scope="module")
def embedded(spark):
    x = np.random.default_rng(7).normal(size=(300, 4)) + np.repeat([[0], [9], [30]], 100, axis=0)
    return spark.createDataFrame([(i, i % 3, r.tolist()) for i, r in enumerate(x)], "vec_id long, label int, embedding array<float>")


@pytest.mark.parametrize("name", ["best_k", "kmeans_sweep"])
def test_searches_move_all_models_together(spark, monkeypatch, seen, embedded, name):
    """2..8 with ten starts are 70 models, all in the first pass: at most 100 passes and two more, not 100 for each k."""
    monkeypatch.setattr(q_cluster, "table", lambda *_: embedded)
    got = getattr(q_cluster, name)(spark, "").collect()
    assert seen[0] == 70 and seen[-2:] == [70, 7] and len(seen) <= kmeans_search.MAX_PASSES + 2
    assert got[0]["k"] == 3 if name == "best_k" else [r["k"] for r in got] == list(range(2, 9))


def test_sweep_is_the_fits_one_by_one(spark, seen, embedded):
    vectors = clustering.to_vectors(embedded.select("vec_id", *[F.get("embedding", F.lit(i)).cast("double").alias(f"f{i}") for i in range(4)]), [f"f{i}" for i in range(4)])
    swept = clustering.sweep_k(vectors, ks=(4, 2, 3), n_init=2).collect()
    assert seen[0] == 6 and [r["k"] for r in swept] == [4, 2, 3] and vectors not in clustering._sweeps
    for r in swept:
        alone = clustering.fit_kmeans(vectors, r["k"], n_init=2)
        assert r["inertia"] == pytest.approx(alone.cost, rel=1e-12) and r["silhouette"] == pytest.approx(alone.silhouette, rel=1e-9)
    empty = vectors.limit(0)
    with pytest.raises(ValueError):
        clustering.sweep_k(empty)
    assert empty not in clustering._sweeps
