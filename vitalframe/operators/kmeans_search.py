"""Search of k with all models trained together: one pass over the points moves the centres of every unfinished model.

A pass sums, in each task and for every model, the points nearest to each centre; Spark adds the tasks' sums up, so the
driver gets a number per model, centre and dimension, however many points and tasks there are. Models that have
converged drop out. The costs, sizes and silhouettes of the final models take one pass each, for all models at once.

Equal vectors move together, so the points may be the distinct vectors with their numbers (`pooled`): the same sums, sizes,
costs and silhouettes, from passes that grow with the different vectors instead of the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalframe.operators.sampling import sample_rows
from vitalframe.sources.scratch import materialise

#: Points that starting centres are drawn from, by k-means++; about so many rows reach the driver.
SEED_SAMPLE = 10_000
#: Points that a task takes at a time.
ROWS = 4096
#: Centres that are compared with them at a time.
CENTRES = 512
#: Column that says how many rows a point stands for; without it, one.
NUMBER = "_rows"
MAX_PASSES, TOLERANCE = 100, 1e-4


@dataclass
class Model:
    """One start of one k."""

    k: int
    start: int
    centres: np.ndarray
    passes: int = 0
    cost: float = float("nan")
    sizes: np.ndarray | None = None
    silhouette: float | None = None


def plus_plus(points: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k starting centres among the points, each drawn by its squared distance to those before."""
    chosen = [points[rng.integers(len(points))]]
    nearest = ((points - chosen[0]) ** 2).sum(1)
    for _ in range(k - 1):
        total = nearest.sum()
        at = rng.choice(len(points), p=nearest / total) if total > 0 else rng.integers(len(points))
        chosen.append(points[at])
        nearest = np.minimum(nearest, ((points - chosen[-1]) ** 2).sum(1))
    return np.array(chosen)


def _squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((x**2).sum(1)[:, None] - 2 * x @ centres.T + (centres**2).sum(1)[None, :], 0.0)


def _points(parts: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Vectors, and how many rows each stands for."""
    for part in parts:
        for lo in range(0, part.num_rows, ROWS):
            rows = part.column("x").slice(lo, ROWS)
            x = rows.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), width)
            yield x, part.column(NUMBER).slice(lo, ROWS).to_numpy().astype(float) if NUMBER in part.schema.names else np.ones(len(rows))


def _gathered(points: DataFrame, length: int, add: Callable[[np.ndarray, np.ndarray, np.ndarray], None], width: int) -> np.ndarray:
    """Sum over all tasks of a vector of numbers that ``add`` fills batch by batch."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(length)
        for x, number in _points(parts, width):
            add(total, x, number)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["slot", "value"])

    rows = points.mapInArrow(run, "slot long, value double").groupBy("slot").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros(length)
    out[rows.column("slot").to_numpy()] = rows.column("value").to_numpy()
    return out


def _bunches(models: Sequence[np.ndarray]) -> list[tuple[np.ndarray, list[tuple[int, int]]]]:
    """Models of up to ``CENTRES`` centres together, or a larger one alone: their centres stacked, and each model's rows of these."""
    bunches: list[list[np.ndarray]] = []
    for centres in models:
        if not bunches or sum(map(len, bunches[-1])) + len(centres) > CENTRES:
            bunches.append([])
        bunches[-1].append(centres)
    out = []
    for bunch in bunches:
        ends = np.cumsum([0, *map(len, bunch)]).tolist()
        out.append((np.concatenate(bunch), list(zip(ends, ends[1:]))))
    return out


def _nearest(x: np.ndarray, norms: np.ndarray, stacked: np.ndarray, limits: Sequence[tuple[int, int]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Model by model of a bunch, each point's nearest centre, the first on ties, and its squared distance.

    One product of matrices serves the whole bunch.
    """
    squares = stacked @ x.T
    squares *= -2
    squares += norms
    squares += (stacked**2).sum(1)[:, None]
    np.maximum(squares, 0.0, out=squares)
    for lo, hi in limits:
        label, least = np.zeros(len(x), np.intp), squares[lo].copy()
        for j in range(1, hi - lo):
            np.copyto(label, j, where=squares[lo + j] < least)
            np.minimum(least, squares[lo + j], out=least)
        yield squares[lo:hi].argmin(0) if np.isnan(least).any() else label, least


def _assigned(models: Sequence[np.ndarray], width: int) -> Callable[[np.ndarray, np.ndarray, np.ndarray], None]:
    """Adds, for the centres of all models, the sums of their points, their squared norms and number; then the models' costs."""
    bunches = _bunches(models)

    def add(total: np.ndarray, x: np.ndarray, number: np.ndarray) -> None:
        norms, here, at = (x**2).sum(1), np.arange(len(x)), 0
        moments, costs = np.column_stack([x, norms, np.ones(len(x))]), []
        for stacked, limits in bunches:
            member = np.zeros((len(stacked), len(x)))
            for (lo, _), (label, least) in zip(limits, _nearest(x, norms, stacked, limits)):
                member[lo + label, here] = number
                costs.append(least @ number)
            size = len(stacked) * (width + 2)
            total[at : at + size] += (member @ moments).reshape(-1)
            at += size
        total[at:] += costs

    return add


def _statistics(points: DataFrame, models: Sequence[np.ndarray], width: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, float]]:
    """Per model: the centres' sums, sizes and squared norms, and the cost."""
    n = sum(map(len, models))
    total, out, at = _gathered(points, n * (width + 2) + len(models), _assigned(models, width), width), [], 0
    moments, costs = total[: n * (width + 2)].reshape(n, width + 2), total[n * (width + 2) :]
    for centres, cost in zip(models, costs):
        mine = moments[at : at + len(centres)]
        out.append((mine[:, :width], mine[:, width + 1], mine[:, width], float(cost)))
        at += len(centres)
    return out


def _silhouettes(points: DataFrame, models: Sequence[Model], stats: Sequence[tuple], width: int) -> list[float | None]:
    """Mean silhouette of squared distances of each model; None with fewer than two clusters.

    The mean squared distance to a cluster follows from its size, sum and squared norms, so this is linear in the points.
    """
    scored, bunches = [(sums, sizes, norms) for sums, sizes, norms, _ in stats], _bunches([m.centres for m in models])

    def add(total: np.ndarray, x: np.ndarray, number: np.ndarray) -> None:
        own_norm, here = (x**2).sum(1), np.arange(len(x))
        labels = (label for stacked, limits in bunches for label, _ in _nearest(x, own_norm, stacked, limits))
        for i, ((sums, sizes, norms), label) in enumerate(zip(scored, labels)):
            whole = np.maximum(own_norm[:, None] * sizes - 2 * x @ sums.T + norms, 0.0)
            mine = whole[here, label] / np.maximum(sizes[label] - 1, 1)
            with np.errstate(divide="ignore", invalid="ignore"):
                mean = np.where(sizes > 0, whole / sizes, np.inf)
            mean[here, label] = np.inf
            other = mean.min(1)
            most = np.maximum(mine, other)
            score = np.where((sizes[label] > 1) & (most > 0), (other - mine) / np.where(most > 0, most, 1), 0.0)
            total[i] += (score * number).sum() if (sizes > 0).sum() > 1 else 0.0

    total = _gathered(points, len(models), add, width)
    return [float(total[i] / sizes.sum()) if (sizes > 0).sum() > 1 else None for i, (_, sizes, _, _) in enumerate(stats)]


def train(points: DataFrame, width: int, models: Sequence[Model], max_passes: int = MAX_PASSES, tolerance: float = TOLERANCE) -> None:
    """Move the centres of all models, a pass over ``points`` a step, until none moves by more than ``tolerance``.

    A centre that has no points stays where it is.
    """
    live = list(models)
    for _ in range(max_passes):
        moving = []
        for m, (sums, sizes, _, _) in zip(live, _statistics(points, [m.centres for m in live], width)):
            centres = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], m.centres)
            moved = np.sqrt(((centres - m.centres) ** 2).sum(1)).max()
            m.centres, m.passes = centres, m.passes + 1
            if moved > tolerance:
                moving.append(m)
        live = moving
        if not live:
            return


def as_points(vectors: DataFrame, *keep: str) -> DataFrame:
    """Rows (kept columns, x): the vectors as arrays, written in even parts that every pass reads again."""
    n = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = dict(vectors.dtypes)["features"]
    x = vector_to_array("features") if kind == "vector" else F.col("features").cast("array<double>")
    return materialise(vectors.select(*keep, x.alias("x")).repartition(n), "points")


def pooled(vectors: DataFrame) -> DataFrame:
    """Rows (x, _rows): the distinct vectors and how many rows have each, written once, in even parts, for all passes."""
    n = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = dict(vectors.dtypes)["features"]
    x = vector_to_array("features") if kind == "vector" else F.col("features").cast("array<double>")
    return materialise(vectors.groupBy(x.alias("x")).agg(F.count("*").alias(NUMBER)).repartition(n), "points")


def _seeds(points: DataFrame, n: int, seed: int) -> np.ndarray:
    """Vectors that starting centres are drawn from, sorted: about n rows at random, all if there are fewer."""
    if NUMBER not in points.columns:
        return np.array(sorted(sample_rows(points.select("x"), n, seed, []).toArrow().column("x").to_pylist()), float)
    total = points.agg(F.sum(NUMBER)).first()[0] or 0
    share = min(1.0, n / total) if total else 1.0

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng([seed, TaskContext.get().partitionId()])
        for part in parts:
            drawn = rng.binomial(part.column(NUMBER).to_numpy(), share)
            kept = part.set_column(part.schema.get_field_index(NUMBER), NUMBER, pa.array(drawn))
            yield kept.filter(pa.array(drawn > 0))

    rows = sorted((r["x"], r[NUMBER]) for r in points.mapInArrow(run, points.schema).toArrow().to_pylist())
    return np.repeat(np.array([x for x, _ in rows], float), [c for _, c in rows], axis=0) if rows else np.array([])


def search(
    vectors: DataFrame, ks: Sequence[int] = range(2, 9), n_init: int = 10, seed: int = 42, seed_sample: int = SEED_SAMPLE, keep: Sequence[str] = ()
) -> tuple[DataFrame, list[Model]]:
    """The points, a row per vector, and what `search_points` finds on them."""
    points = as_points(vectors, *keep)
    return points, search_points(points, ks, n_init, seed, seed_sample)


def search_points(
    points: DataFrame, ks: Sequence[int] = range(2, 9), n_init: int = 10, seed: int = 42, seed_sample: int = SEED_SAMPLE
) -> list[Model]:
    """For each k, the best by cost of ``n_init`` starts, all trained together over all points.

    Only the starting centres come from a sample, of ``seed_sample`` rows. An empty table gives no model.
    """
    seeds = _seeds(points, seed_sample, seed)
    if not len(seeds):
        return []
    width = seeds.shape[1]
    models = [Model(k, s, plus_plus(seeds, k, np.random.default_rng([seed, k, s]))) for k in ks for s in range(n_init)]
    slim = points.select("x", *[c for c in points.columns if c == NUMBER])
    train(slim, width, models)
    for m, (_, sizes, _, cost) in zip(models, _statistics(slim, [m.centres for m in models], width)):
        m.sizes, m.cost = sizes, cost
    best = [min((m for m in models if m.k == k), key=lambda m: (m.cost, m.start)) for k in ks]
    stats = _statistics(slim, [m.centres for m in best], width)
    for m, score in zip(best, _silhouettes(slim, best, stats, width)):
        m.silhouette = score
    return best


def search_table(spark, best: Sequence[Model]) -> DataFrame:
    """``(k, inertia, silhouette)`` as `sweep_k` returns them."""
    return spark.createDataFrame([(m.k, m.cost, m.silhouette) for m in best], "k int, inertia double, silhouette double")


def chosen(best: Sequence[Model]) -> Model:
    """The model with the highest silhouette, the smallest k on ties; without any score, the smallest k."""
    return max(best, key=lambda m: (m.silhouette is not None, m.silhouette or 0.0, -m.k))


def assign(points: DataFrame, model: Model) -> DataFrame:
    """``points`` with ``cluster``, the nearest centre, numbered by falling size; the model is not fitted again."""
    order = np.argsort(-model.sizes, kind="stable")
    centres = model.centres[order]
    schema = points.select("*").withColumn("cluster", F.lit(0)).schema

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            label = [_squares(x, centres).argmin(1) for x, _ in _points(iter([part]), centres.shape[1])]
            column = pa.array(np.concatenate(label).astype(np.int32)) if label else pa.array([], pa.int32())
            yield pa.RecordBatch.from_arrays([*part.columns, column], [*part.schema.names, "cluster"])

    return points.mapInArrow(run, schema)
