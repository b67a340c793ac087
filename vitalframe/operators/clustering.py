"""K-means segmentation: features, choice of k, assignment, projection and profiles."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from weakref import WeakKeyDictionary

import numpy as np
import pyarrow as pa
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalframe.operators import kmeans_search
from vitalframe.operators.counts import mean_by, melt, mode_by, sum_counts
from vitalframe.operators.sampling import sample_rows
from vitalframe.sources.scratch import materialise

#: Points in one block of the exact silhouette.
BLOCK = 1_000
PLOT_SAMPLE = 20_000
MAX_LEVELS = 50

_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
_BLOCK_SCHEMA = "block long, n long, x binary, codes binary"
_BLOCK_ARROW = pa.schema([("block", pa.int64()), ("n", pa.int64()), ("x", pa.binary()), ("codes", pa.binary())])

# Columns that would dominate the indicators, and name fragments of such columns.
EXCLUDED_FEATURES = ("mesreg", "mesocu", "depreg", "depocu", "dredif", "dnadif")
EXCLUDED_FRAGMENTS = ("mun", "mup")


def choose_features(profile: DataFrame, identifiers: Sequence[str]) -> tuple[list[str], list[str]]:
    """Numeric and categorical feature names from a variable profile.

    The profile has one row per column, so it is read on the driver.
    """
    from vitalframe.operators.profile import select_columns

    def names(rows: DataFrame) -> list[str]:
        return [r["column"] for r in rows.orderBy("position").select("column").collect()]

    numeric = names(select_columns(profile, "numeric", min_cover=0.7))
    categorical = names(select_columns(profile, "categorical", 2, 15, 0.7))
    return (
        [c for c in numeric if c not in identifiers],
        [
            c
            for c in categorical
            if c not in EXCLUDED_FEATURES and not any(p in c for p in EXCLUDED_FRAGMENTS)
        ],
    )


def category_levels(
    df: DataFrame, cols: Sequence[str], max_levels: int = MAX_LEVELS
) -> dict[str, list[str]]:
    """Sorted levels of each categorical column.

    A planning step: at most ``max_levels + 1`` rows per column reach the driver, and a column
    with more levels is refused.
    """
    if not cols:
        return {}
    counts = melt(df, cols, kind="string").dropna(subset=["value"]).distinct()
    rank = F.row_number().over(Window.partitionBy("column").orderBy("value"))
    rows = counts.withColumn("_rank", rank).where(F.col("_rank") <= max_levels + 1).collect()
    levels: dict[str, list[str]] = {c: [] for c in cols}
    for r in rows:
        levels[r["column"]].append(r["value"])
    for c, found in levels.items():
        if len(found) > max_levels:
            raise ValueError(f"{c} has more than {max_levels} levels")
    return {c: sorted(found) for c, found in levels.items()}


def one_hot(
    df: DataFrame, nums: Sequence[str], cats: Sequence[str], keep: Sequence[str] = ()
) -> tuple[DataFrame, list[str]]:
    """Complete rows with numeric columns and one indicator per level (all levels kept)."""
    complete = df.dropna(subset=[*nums, *cats])
    levels = category_levels(complete, cats)
    indicators = {
        f"{c}_{v}": (F.col(c).cast("string") == v).cast("double") for c in cats for v in levels[c]
    }
    encoded = complete.select(
        *keep,
        *[F.col(c).cast("double").alias(c) for c in nums],
        *[e.alias(name) for name, e in indicators.items()],
    )
    return encoded, [*nums, *indicators]


def standardise(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Centre and divide by the population deviation; constant columns become 0.

    One planning aggregate returns a single row of means and deviations.
    """
    wide = df.agg(
        *[
            F.struct(F.avg(f"`{c}`").alias("m"), F.stddev_pop(f"`{c}`").alias("s")).alias(f"_f{i}")
            for i, c in enumerate(features)
        ]
    ).first()

    def scaled(i: int, c: str) -> Column:
        mean, sd = wide[i]["m"], wide[i]["s"]
        return ((F.col(f"`{c}`") - F.lit(mean)) / F.lit(sd or 1.0)).alias(c)

    others = [c for c in df.columns if c not in features]
    return df.select(
        *[F.col(f"`{c}`") for c in others], *[scaled(i, c) for i, c in enumerate(features)]
    )


def to_vectors(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    packed = F.array(*[F.col(f"`{c}`") for c in features])
    return df.select(*keep, array_to_vector(packed).alias("features"))


_pooled: WeakKeyDictionary[DataFrame, DataFrame] = WeakKeyDictionary()


def pooled(vectors: DataFrame) -> DataFrame:
    """The distinct vectors with their numbers, written once per frame however many fits ask for them."""
    if vectors not in _pooled:
        _pooled[vectors] = kmeans_search.pooled(vectors)
    return _pooled[vectors]


@dataclass
class _Sweep:
    """Fits that a sweep is about to ask for: its ks, and by starts and seed the models of all of them."""

    ks: list[int]
    found: dict[tuple[int, int], dict[int, kmeans_search.Model]] = field(default_factory=dict)


_sweeps: WeakKeyDictionary[DataFrame, _Sweep] = WeakKeyDictionary()


def fit_kmeans(
    vectors: DataFrame, k: int, n_init: int = 10, seed: int = 42, parallelism: int = 4
) -> kmeans_search.Model:
    """Best of ``n_init`` seeded starts by cost, over all rows.

    The starts move together, a pass over the distinct vectors a step, so there is nothing for ``parallelism`` to do;
    callers may still pass it. Within a sweep the first fit moves the starts of all its ks in the same passes, and the
    others find theirs done; no start depends on another, so each model is the one that a fit of its own gives.
    """
    sweep = _sweeps.get(vectors)
    if sweep is None or k not in sweep.ks:
        sweep = _Sweep([k])
    if (n_init, seed) not in sweep.found:
        sweep.found[n_init, seed] = {m.k: m for m in kmeans_search.search_points(pooled(vectors), sweep.ks, n_init, seed)}
    if k not in sweep.found[n_init, seed]:
        raise ValueError("k-means needs at least one row")
    return sweep.found[n_init, seed][k]


def sweep_k(
    vectors: DataFrame,
    ks: Sequence[int] = range(2, 9),
    n_init: int = 10,
    seed: int = 42,
    key: Sequence[str] = (),
    parallelism: int = 4,
    sample_n: int | None = None,
) -> DataFrame:
    """``(k, inertia, silhouette)`` of the best fit of each k, over all rows; the fits share their passes.

    The silhouette is of squared distances, linear in the rows, and NULL when a fit leaves fewer than two
    clusters. ``sample_n`` fits and scores a random sample of that size instead.
    """
    rows = vectors if sample_n is None else sample_rows(vectors, sample_n, seed, key)
    _sweeps[rows] = _Sweep(list(dict.fromkeys(ks)))
    try:
        best = [fit_kmeans(rows, k, n_init, seed, parallelism) for k in ks]
    finally:
        _sweeps.pop(rows, None)
    return kmeans_search.search_table(vectors.sparkSession, best)


def _blob(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()


def _packing(table: pa.Table) -> pa.Table:
    """One block as one row: its points and its label codes."""
    points, codes = (np.array(table.column(c).to_pylist()) for c in ("x", "codes"))
    block = {"block": table.column("block")[:1], "n": [len(points)]}
    return pa.table(block | {"x": [_blob(points.astype("<f8"))], "codes": [_blob(codes.astype("<i4"))]}, _BLOCK_ARROW)


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    shift = x.mean(axis=0)
    x, y = x - shift, y - shift
    squared = (x**2).sum(axis=1)[:, None] + (y**2).sum(axis=1)[None, :] - 2 * x @ y.T
    return np.sqrt(np.maximum(squared, 0.0))


def _summing(levels: Sequence[int]):
    """Pairs of blocks: for each point of both, the distances to the other block's points by cluster."""
    starts = np.cumsum([0, *levels])

    def members(codes: np.ndarray) -> np.ndarray:
        out = np.zeros((len(codes), starts[-1]))
        for j, start in enumerate(starts[:-1]):
            out[np.arange(len(codes)), start + codes[:, j]] = 1.0
        return out

    def sent(sums: dict) -> pa.RecordBatch:
        columns = [pa.array(list(sums), pa.int64()), pa.array([_blob(v) for v in sums.values()], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["block", "sums"])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for part in parts:
            for r in part.to_pylist():
                x = np.frombuffer(r["x"], "<f8").reshape(r["n"], -1)
                y = np.frombuffer(r["other_x"], "<f8").reshape(r["other_n"], -1)
                of_x, of_y = (members(np.frombuffer(r[c], "<i4").reshape(-1, len(levels))) for c in ("codes", "other_codes"))
                distance = _distances(x, y)
                if r["block"] == r["other"]:
                    np.fill_diagonal(distance, 0.0)
                else:
                    back = distance.T @ of_x
                    sums[r["other"]] = sums[r["other"]] + back if r["other"] in sums else back
                there = distance @ of_y
                sums[r["block"]] = sums[r["block"]] + there if r["block"] in sums else there
                if len(sums) >= 64:
                    yield sent(sums)
                    sums = {}
        if sums:
            yield sent(sums)

    return run


def _scoring(names: Sequence[str], sizes: Sequence[Sequence[int]]):
    """One block: the silhouettes of its points, summed, from all their distance sums."""
    starts = np.cumsum([0, *map(len, sizes)])

    def run(table: pa.Table) -> pa.Table:
        codes = np.frombuffer(table.column("codes")[0].as_py(), "<i4").reshape(-1, len(names))
        total = np.zeros((len(codes), starts[-1]))
        for blob in table.column("sums"):
            total += np.frombuffer(blob.as_py()).reshape(total.shape)
        here, out = np.arange(len(codes)), []
        for j, size in enumerate(map(np.array, sizes)):
            sums, mine = total[:, starts[j] : starts[j + 1]], codes[:, j]
            inside = sums[here, mine] / np.maximum(size[mine] - 1, 1)
            means = sums / size
            means[here, mine] = np.inf
            nearest = means.min(axis=1)
            s = (nearest - inside) / np.maximum(np.maximum(nearest, inside), 1e-300)
            s[size[mine] == 1] = 0.0
            out.append(float(s.sum()) if len(size) > 1 else float("nan"))
        return pa.table({"labelling": list(names), "s": out, "n": [len(codes)] * len(names)})

    return run


def exact_silhouette(
    points: DataFrame, labels: Sequence[str], limit: int | None = None
) -> DataFrame:
    """``(labelling, silhouette)``: exact mean silhouette with Euclidean distance, all rows against all.

    Rows are dealt to blocks, and blocks to a square of cells, half of which hold every pair of blocks
    once. Each task sums its distances per point and cluster, for all labellings at once; pairs of points
    are never rows. The time grows with the square of the rows, memory does not. Labels are planned on the
    driver, a row per cluster. With ``limit``, more points than that are refused; to score a sample, pass one.
    """
    spark = points.sparkSession
    kind = dict(points.dtypes)["features"]
    features = vector_to_array("features") if kind == "vector" else F.col("features").cast("array<double>")
    rows = points.select(features.alias("x"), *[F.col(c).cast("int").alias(f"_l{j}") for j, c in enumerate(labels)])
    rows = rows.withColumn("row", F.monotonically_increasing_id()).persist()
    counted = melt(rows, [f"_l{j}" for j in range(len(labels))], kind="int").groupBy("column", "value").agg(F.count("*").alias("n"))
    found: dict[str, dict[int, int]] = {}
    for r in counted.collect():
        found.setdefault(r["column"], {})[r["value"]] = r["n"]
    if any(None in levels for levels in found.values()):
        raise ValueError("labels must not be NULL")
    n = sum(found["_l0"].values()) if found else 0
    if limit is not None and n > limit:
        raise ValueError(f"exact silhouette takes at most {limit} points")

    order = [sorted(found.get(f"_l{j}", {})) for j in range(len(labels))]
    codes = [F.array_position(F.lit(levels).cast("array<int>"), F.col(f"_l{j}")).cast("int") - 1 for j, levels in enumerate(order)]
    blocks = -(-n // BLOCK)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # So many groups of blocks that half of their square gives each task a cell, of at most 8 x 8 blocks.
    groups = min(blocks, max(int(np.ceil(np.sqrt(2 * tasks))), -(-blocks // 8))) or 1

    dealt = rows.select(F.pmod("row", F.lit(max(blocks, 1))).alias("block"), "x", F.array(*codes).alias("codes"))
    packed = materialise(dealt.groupBy("block").applyInArrow(_packing, _BLOCK_SCHEMA), "blocks")
    rows.unpersist()
    group = F.pmod("block", F.lit(groups))
    left = packed.withColumn("column", F.explode(F.sequence(group, F.lit(groups - 1).cast("long")))).withColumn("row", group)
    right = packed.withColumn("row", F.explode(F.sequence(F.lit(0).cast("long"), group))).withColumn("column", group)
    right = right.withColumnsRenamed({"block": "other", "n": "other_n", "x": "other_x", "codes": "other_codes"})
    pairs = left.hint("merge").join(right, ["row", "column"]).where("row < column OR block <= other")
    batch = spark.conf.get(_BATCH_SETTING)
    spark.conf.set(_BATCH_SETTING, "4")  # a row holds two blocks
    try:
        sums = materialise(pairs.mapInArrow(_summing([len(x) for x in order]), "block long, sums binary"), "sums")
    finally:
        spark.conf.set(_BATCH_SETTING, batch)
    sizes = [[found[f"_l{j}"][v] for v in levels] for j, levels in enumerate(order)]
    scored = sums.join(packed.select("block", "codes"), "block").groupBy("block")
    scored = scored.applyInArrow(_scoring(list(labels), sizes), "labelling string, s double, n long")
    return scored.groupBy("labelling").agg((F.sum("s") / F.sum("n")).alias("silhouette"))


def squared_silhouette(points: DataFrame, label: str = "prediction") -> float:
    """Mean silhouette with squared Euclidean distance over all rows, linear in the rows."""
    evaluator = ClusteringEvaluator(predictionCol=label, distanceMeasure="squaredEuclidean")
    return evaluator.evaluate(points)


def best_k(sweep: DataFrame) -> DataFrame:
    """k with the highest silhouette, the smallest on ties."""
    best = F.max_by("k", F.struct(F.col("silhouette"), -F.col("k")))
    return sweep.agg(best.alias("k"), F.max("silhouette").alias("silhouette"))


def assign_clusters(
    vectors: DataFrame, k: int, n_init: int = 10, seed: int = 42, parallelism: int = 4
) -> tuple[DataFrame, kmeans_search.Model]:
    """Fit on all rows and add ``cluster``, the nearest centre; clusters are numbered by falling size."""
    model = fit_kmeans(vectors, k, n_init, seed, parallelism)
    x = vector_to_array("features") if dict(vectors.dtypes)["features"] == "vector" else F.col("features").cast("array<double>")

    def square(centre: np.ndarray) -> Column:
        here = F.array(*[F.lit(float(v)) for v in centre])
        return F.aggregate(F.zip_with("_x", here, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda total, v: total + v)

    squares = F.array(*[square(c) for c in model.centres[np.argsort(-model.sizes, kind="stable")]])
    placed = vectors.withColumn("_x", x).withColumn("_squares", squares)
    cluster = (F.array_position("_squares", F.array_min("_squares")) - 1).cast("int")
    return placed.withColumn("cluster", cluster).drop("_x", "_squares"), model


def cluster_sizes(vectors: DataFrame, model: kmeans_search.Model) -> DataFrame:
    """``(cluster, n)`` over all rows, by placing the distinct vectors; clusters are numbered by falling size."""
    return sum_counts(kmeans_search.assign(pooled(vectors), model), "cluster", n=kmeans_search.NUMBER).withColumnRenamed(kmeans_search.NUMBER, "n")


def project_2d(vectors: DataFrame) -> tuple[DataFrame, list[float]]:
    """Two principal components of centred vectors and their share of the variance."""
    model = PCA(k=2, inputCol="features", outputCol="_pc").fit(vectors)
    pc = vector_to_array("_pc")
    projected = model.transform(vectors).withColumn("pc1", pc[0]).withColumn("pc2", pc[1])
    return projected.drop("_pc"), [float(v) for v in model.explainedVariance]


def cluster_profile(df: DataFrame, cats: Sequence[str], cluster: str = "cluster") -> DataFrame:
    """``(cluster, column, value, pct)``: row percentages of each categorical variable.

    All variables share one scan and one shuffle of counts; absent combinations are 0.
    """
    long = melt(df, cats, by=[cluster], kind="string").dropna(subset=[cluster, "value"])
    counts = long.groupBy(cluster, "column", "value").agg(F.count("*").alias("n"))
    keys = counts.groupBy("column").agg(F.array_sort(F.collect_set("value")).alias("_keys"))
    packed = counts.groupBy(cluster, "column").agg(
        F.map_from_entries(F.collect_list(F.struct("value", "n"))).alias("_cells"),
        F.sum("n").alias("_total"),
    )
    expanded = packed.join(keys, "column").select(
        cluster, "column", "_cells", "_total", F.explode("_keys").alias("value")
    )
    n = F.coalesce(F.try_element_at("_cells", F.col("value")), F.lit(0))
    return expanded.select(cluster, "column", "value", (n / F.col("_total") * 100).alias("pct"))


def cluster_means(df: DataFrame, nums: Sequence[str], cluster: str = "cluster") -> DataFrame:
    return mean_by(df, cluster, nums)


def semantic_name(age: Column, assistance: Column) -> Column:
    """Name of a group from its mean age and its predominant assistance."""
    # Group names, age limits and the text that marks medical assistance.
    attended = F.when(F.contains(assistance, F.lit("Médica")), "Con Asistencia").otherwise(
        "Sin Asistencia"
    )
    return (
        F.when(age < 12, "Mortalidad Infantil/Neonatal")
        .when(age.between(15, 45), "Riesgo Joven / Edad Productiva")
        .when(age > 45, F.concat(F.lit("Adultos Mayores ("), attended, F.lit(")")))
        .otherwise("Mortalidad Adulta General")
    )


def cluster_names(
    df: DataFrame,
    cluster: str = "cluster",
    age: str = "edadif",
    sex: str = "sexo",
    assistance: str = "asist",
) -> DataFrame:
    """``(cluster, name, mean_age, sex, assistance)`` per cluster."""
    joined = mean_by(df, cluster, [age]).join(mode_by(df, cluster, [sex, assistance]), cluster)
    return joined.select(
        F.col(cluster).alias("cluster"),
        semantic_name(F.col(age), F.col(assistance)).alias("name"),
        F.col(age).alias("mean_age"),
        F.col(sex).alias("sex"),
        F.col(assistance).alias("assistance"),
    )
