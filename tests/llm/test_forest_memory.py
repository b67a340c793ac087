"""Comparing tasks of the projection forest stay small, whatever the leaves that vectors fall in."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa

from vitalframe.llm import rpforest


def _block(leaves: list[list[int]], leaf: int, units: np.ndarray) -> pa.Table:
    n = len(units)
    return pa.table(
        {
            "leaf": np.full(n, leaf),
            "low": np.zeros(n, np.int64),
            "high": np.zeros(n, np.int64),
            "block": np.zeros(n, np.int64),
            "rep": np.arange(n),
            "copies": np.ones(n, np.int64),
            "unit": pa.array([u.tobytes() for u in units]),
            "leaves": pa.array(leaves, pa.list_(pa.int32())),
        }
    )


def test_marks_of_many_leaves_are_made_in_slices():
    """800 linked vectors in 20,000 other leaves, two each: marks of all leaves at once would take 64 MB and more."""
    units = np.tile([1.0, 0.0], (800, 1))
    leaves = [[] for _ in units]
    for x in range(20_000):
        leaves[2 * x % 800].append(x)
        leaves[(2 * x + 1) % 800].append(x)
    tracemalloc.start()
    out = rpforest._comparing(0.9)(_block(leaves, 30_000, units))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # Everyone links with 799 others, one of which was met in an earlier leaf.
    assert out.column("degree").to_pylist() == [798] * 800 and set(out.column("root").to_pylist()) == {0}
    assert peak < 48 << 20


def test_comparing_tasks_get_few_rows(spark, monkeypatch):
    """The rows that are compared are dealt to tasks of a bounded size, with the leaves before theirs only."""
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(8).tolist()) for i in range(600)]
    df = spark.createDataFrame([*rows, (600, rows[0][1]), (601, [x * 2 for x in rows[1][1]])], "vec_id long, embedding array<double>")
    seen = []

    def watched(frame, name):
        if name == "found":
            seen.append(frame._jdf.queryExecution().optimizedPlan().toString())
        return kept(frame, name)

    kept = rpforest.materialise
    monkeypatch.setattr(rpforest, "materialise", watched)
    whole = {r.vec_id: (r.n_links, r.component_id) for r in rpforest.near_vectors(df, 0.9).collect()}
    monkeypatch.setattr(rpforest, "TASK_ROWS", 100)
    dealt = {r.vec_id: (r.n_links, r.component_id) for r in rpforest.near_vectors(df, 0.9).collect()}
    assert whole == dealt and len(whole) == 602
    parts = [int(p.split("RepartitionByExpression [")[1].split("], ")[1].split(",")[0].split("\n")[0]) for p in seen]
    assert parts[1] >= 50 > parts[0]
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    linked = (x @ x.T >= 0.9).sum(1) - 1
    assert whole[0][0] >= 1 and all(whole[i][0] <= linked[i] + (i < 2) + 2 for i in range(600))
