"""K-means over distinct vectors with their numbers against k-means over all rows."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from vitalframe.operators import clustering, kmeans_search


@pytest.fixture(scope="module")
def vectors(spark):
    x = np.random.default_rng(5).integers(0, 4, size=(600, 3)) + np.repeat([[0], [20], [50]], 200, axis=0)
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "id long, a array<double>").select("id", array_to_vector("a").alias("features"))


def test_pooled_search_is_the_search_over_all_rows(vectors):
    pooled = kmeans_search.pooled(vectors)
    assert pooled.count() == vectors.select("features").distinct().count() < 250
    _, all_rows = kmeans_search.search(vectors, ks=(2, 3), n_init=2)
    for a, b in zip(all_rows, kmeans_search.search_points(pooled, ks=(2, 3), n_init=2)):
        assert np.allclose(a.centres, b.centres) and a.sizes.tolist() == b.sizes.tolist() and a.passes == b.passes
        assert a.cost == pytest.approx(b.cost) and a.silhouette == pytest.approx(b.silhouette)


def test_starts_of_a_fit_move_together(vectors, monkeypatch):
    """Ten starts take one pass a step, over vectors that are pooled once for all fits of a frame."""
    seen, statistics, pool, pools = [], kmeans_search._statistics, kmeans_search.pooled, []
    monkeypatch.setattr(kmeans_search, "_statistics", lambda p, models, w: (seen.append(len(models)), statistics(p, models, w))[1])
    monkeypatch.setattr(kmeans_search, "pooled", lambda v: (pools.append(1), pool(v))[1])
    model = clustering.fit_kmeans(vectors, 3)
    assert seen[0] == 10 and seen[-2:] == [10, 1]
    assert clustering.fit_kmeans(vectors, 2, n_init=1).k == 2 and len(pools) == 1
    assert model.sizes.tolist() == [200, 200, 200]
    placed, fitted = clustering.assign_clusters(vectors, 3)
    by_rows = {r["cluster"]: r["count"] for r in placed.groupBy("cluster").count().collect()}
    assert {r["cluster"]: r["n"] for r in clustering.cluster_sizes(vectors, fitted).collect()} == by_rows == {0: 200, 1: 200, 2: 200}


def test_seeds_of_many_rows(vectors):
    """Starting centres come from about as many rows as asked, each vector by how many rows have it."""
    skewed = vectors.withColumn("features", F.when(F.col("id") < 300, array_to_vector(F.array(*[F.lit(1.0)] * 3))).otherwise(F.col("features")))
    seeds = kmeans_search._seeds(kmeans_search.pooled(skewed), 200, 42)
    assert 140 < len(seeds) < 260 and 0.35 < (seeds == 1.0).all(1).mean() < 0.65
