"""Sums of a pass from one product of matrices for many models."""

import numpy as np
import pytest

from vitalframe.operators import kmeans_search


@pytest.mark.parametrize("centres", [1, 5, 512])
def test_sums_of_models_that_share_a_product(monkeypatch, centres):
    """Each model's sums, norms, sizes and cost, however many centres are compared at a time; ties go to the first centre."""
    monkeypatch.setattr(kmeans_search, "CENTRES", centres)
    rng = np.random.default_rng(2)
    x, number = rng.integers(0, 6, size=(200, 3)).astype(float), rng.integers(1, 4, 200).astype(float)
    models = [x[rng.integers(0, 200, k)] for k in (2, 3, 7, 2)] + [np.array([[1.0, 1, 1], [1, 1, 1]])]

    def gathered(points, length, add, width):
        total = np.zeros(length)
        add(total, x[:150], number[:150])
        add(total, x[150:], number[150:])
        return total

    monkeypatch.setattr(kmeans_search, "_gathered", gathered)
    assert sum(len(m) for m, _ in kmeans_search._bunches(models)) == 16
    for c, (sums, sizes, norms, cost) in zip(models, kmeans_search._statistics(None, models, 3), strict=True):
        square = ((x[:, None, :] - c[None]) ** 2).sum(2)
        member = (square.argmin(1)[:, None] == np.arange(len(c))) * number[:, None]
        assert np.allclose(sums, member.T @ x) and sizes.tolist() == member.sum(0).tolist()
        assert np.allclose(norms, member.T @ (x**2).sum(1)) and cost == pytest.approx((square.min(1) * number).sum())


def test_missing_distances_go_where_argmin_puts_them():
    stacked = np.array([[0.0, 0], [np.nan, 0], [1, 1]])
    x = np.array([[0.0, 0], [5, 5]])
    ((label, least),) = kmeans_search._nearest(x, (x**2).sum(1), stacked, [(0, 3)])
    assert label.tolist() == [1, 1] and np.isnan(least).all()
