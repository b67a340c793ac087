"""Models trained together against models trained one by one, in plain arrays."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from vitalframe.operators import clustering, kmeans_search


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(8)
    centres = np.array([[0, 0, 0], [9, 0, 0], [0, 9, 0], [9, 9, 9]])
    x = np.concatenate([c + rng.normal(size=(60, 3)) for c in centres])
    return np.concatenate([x, x[:5], x[:5]])


@pytest.fixture(scope="module")
def vectors(spark, data):
    rows = [(i, r.tolist()) for i, r in enumerate(data)]
    return spark.createDataFrame(rows, "id long, a array<double>").select("id", array_to_vector("a").alias("features"))


def alone(x, centres):
    """Lloyd's steps of one model."""
    for _ in range(100):
        label = ((x[:, None, :] - centres[None]) ** 2).sum(2).argmin(1)
        after = np.array([x[label == j].mean(0) if (label == j).any() else c for j, c in enumerate(centres)])
        moved = np.sqrt(((after - centres) ** 2).sum(1)).max()
        centres = after
        if moved <= 1e-4:
            break
    square = ((x[:, None, :] - centres[None]) ** 2).sum(2)
    return centres, square.min(1).sum(), np.bincount(square.argmin(1), minlength=len(centres))


def test_together_is_one_by_one(spark, data, vectors):
    points, best = kmeans_search.search(vectors, ks=(2, 3, 4, 5), n_init=3)
    seeds = np.array(sorted(r.tolist() for r in data))
    for m in best:
        runs = [alone(data, kmeans_search.plus_plus(seeds, m.k, np.random.default_rng([42, m.k, s]))) for s in range(3)]
        centres, cost, sizes = min(runs, key=lambda r: r[1])
        assert m.cost == pytest.approx(cost, rel=1e-9)
        assert np.allclose(m.centres, centres, atol=1e-9) and m.sizes.tolist() == sizes.tolist()
        placed = kmeans_search.assign(points, m).select(array_to_vector("x").alias("features"), F.col("cluster").cast("double").alias("prediction"))
        assert m.silhouette == pytest.approx(clustering.squared_silhouette(placed), rel=1e-9)
    table = kmeans_search.search_table(spark, best)
    assert clustering.best_k(table).first()["k"] == kmeans_search.chosen(best).k == 4


def test_clusters_are_numbered_by_size(vectors):
    points, best = kmeans_search.search(vectors, ks=(4,), n_init=2, keep=["id"])
    got = kmeans_search.assign(points, best[0])
    assert got.columns == ["id", "x", "cluster"]
    sizes = {r["cluster"]: r["count"] for r in got.groupBy("cluster").count().collect()}
    assert [sizes[i] for i in range(4)] == sorted(sizes.values(), reverse=True) and sum(sizes.values()) == 250


def test_few_points_and_none(spark, vectors):
    same = spark.range(20).select(array_to_vector(F.array(F.lit(1.0), F.lit(2.0))).alias("features"))
    _, best = kmeans_search.search(same, ks=(2, 3), n_init=2)
    assert [(m.k, m.cost, m.silhouette) for m in best] == [(2, 0.0, None), (3, 0.0, None)]
    assert kmeans_search.chosen(best).k == 2
    assert kmeans_search.search(vectors.limit(0))[1] == []


def test_every_model_takes_part_in_each_pass(vectors, monkeypatch):
    """2..8 with ten starts are 70 models; a pass holds all that still move, and no pass is for one k alone."""
    seen, statistics = [], kmeans_search._statistics
    monkeypatch.setattr(kmeans_search, "_statistics", lambda p, models, w: (seen.append(len(models)), statistics(p, models, w))[1])
    _, best = kmeans_search.search(vectors)
    assert seen[0] == 70 and seen[-2:] == [70, 7] and seen[:-2] == sorted(seen[:-2], reverse=True)
    assert [m.k for m in best] == list(range(2, 9))
