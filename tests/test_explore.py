import math

import pytest
from helpers import rows
from pyspark.sql import functions as F

from vitalframe.operators import charts, clustering, frequency, profile, sampling


def test_frequency_adds_up(spark):
    values = ["a"] * 5 + ["b"] * 3 + ["c"] * 2 + [None]
    df = spark.createDataFrame([(v, str(i)) for i, v in enumerate(values)], "x string, id string")
    got = frequency.frequency_table(df, ["x", "id"]).orderBy("position").collect()
    assert [(r["value"], r["n"], r["pct"], r["cum_pct"]) for r in got if r["column"] == "x"] == [
        ("a", 5, 50.0, 50.0), ("b", 3, 30.0, 80.0), ("c", 2, 20.0, 100.0),
    ]


def test_frequency_top_and_others(spark):
    df = spark.createDataFrame([(str(i % 7),) for i in range(70)], "x string")
    got = frequency.frequency_table(df, ["x"], top=3).collect()
    assert len(got) == 3
    assert {(r["n_categories"], r["others"]) for r in got} == {(7, 4)}


def test_frequency_is_complete(spark):
    rows = [(f"v{i:02}",) for i in range(60) for _ in range(1 + i % 3)]
    got = frequency.frequency_table(spark.createDataFrame(rows, "x string").repartition(5), ["x"]).orderBy("position").collect()
    assert [r["position"] for r in got] == list(range(1, 61))
    assert [r["value"] for r in got] == sorted({v for v, in rows}, key=lambda v: (-(1 + int(v[1:]) % 3), v))
    assert got[-1]["cum_pct"] == 100.0 and {(r["n_categories"], r["others"]) for r in got} == {(60, 0)}


def test_histogram_closes_the_last_bin(spark):
    df = spark.createDataFrame([(float(x),) for x in range(31)], "x double")
    got = charts.histogram(df, "x", 30).orderBy("bin").collect()
    assert [r["n"] for r in got] == [1] * 29 + [2]
    flat = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    got = charts.histogram(flat, "x", 4).orderBy("bin").collect()
    assert [r["n"] for r in got] == [0, 0, 2, 0]


def test_box_whiskers(spark):
    xs = [1.0, 2.0, 3.0, 4.0, 100.0]
    df = spark.createDataFrame([("a", x) for x in xs] + [("b", 7.0)], "g string, x double")
    boxes = charts.box_stats(df, "x", "g", ["b", "a"]).collect()
    assert [r["g"] for r in boxes] == ["b", "a"]
    a = boxes[1]
    assert (a["q1"], a["median"], a["q3"]) == (2.0, 3.0, 4.0)
    assert (a["whisker_lo"], a["whisker_hi"], a["fliers_hi"]) == (1.0, 4.0, 1)
    assert rows(charts.box_fliers(df, "x", "g")) == [("a", 100.0, 1)]


def test_density_integrates_to_one(spark):
    df = spark.createDataFrame(
        [("m", float(x % 40)) for x in range(400)] + [("f", float(x)) for x in range(30)] + [("one", 1.0)],
        "g string, x double",
    )
    got = charts.density_curve(df, "x", "g").collect()
    for g in ("m", "f"):
        curve = sorted((r["x"], r["density"]) for r in got if r["g"] == g)
        assert len(curve) == 200
        area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(curve, curve[1:]))
        assert area == pytest.approx(1, abs=0.01)
    assert not [r for r in got if r["g"] == "one"]


def test_density_against_direct_sum(spark):
    xs = [1.0, 1.0, 2.0, 5.0]
    df = spark.createDataFrame([("g", x) for x in xs], "g string, x double")
    mean = sum(xs) / 4
    sd = math.sqrt(sum((x - mean) ** 2 for x in xs) / 3)
    h = sd * 4**-0.2
    for r in charts.density_curve(df, "x", "g", grid=5).collect():
        direct = sum(math.exp(-(((r["x"] - x) / h) ** 2) / 2) for x in xs) / (4 * h * math.sqrt(2 * math.pi))
        assert r["density"] == pytest.approx(direct)


def test_sampling_is_exact_and_repeatable(spark):
    df = spark.range(50_000)
    first = rows(sampling.sample_rows(df, 100, key=["id"]))
    again = rows(sampling.sample_rows(df.repartition(7), 100, key=["id"]))
    assert first == again and len(set(first)) == 100
    assert sampling.sample_rows(spark.range(30), 100, key=["id"]).count() == 30
    assert sampling.sample_rows(df, 100).count() == 100
    spreads = [r[0] for r in first]
    assert min(spreads) < 5_000 and max(spreads) > 45_000


def test_keyed_sample_equals_full_sort(spark):
    df = spark.range(5_000)
    scored = df.withColumn("s", sampling.sample_score(42, ["id"])).orderBy("s").limit(64).drop("s")
    assert rows(scored) == rows(sampling.sample_rows(df, 64, key=["id"]))


def test_group_samples_equal_full_ranking(spark):
    # One group holds most rows; the result must match ranking everything.
    df = spark.range(9_000).selectExpr("id", "CASE WHEN id % 100 = 0 THEN 'rare' ELSE 'hot' END AS g")
    got = sampling.sample_per_group(df, "g", ["hot", "rare", "absent"], 50, key=["id"])
    scored = df.withColumn("s", sampling.sample_score(42, ["id", "g"])).collect()
    want = []
    for g in ("hot", "rare"):
        best = sorted((r["s"], r["id"]) for r in scored if r["g"] == g)[:50]
        want += [(i, g) for _, i in best]
    assert rows(got) == sorted(want)
    assert sampling.sample_per_group(df, "g", ["rare"], 5_000).count() == 90


def test_profile_roles(spark):
    df = spark.createDataFrame(
        [(2012.0, float(i), "x" if i % 2 else None, None) for i in range(10)],
        "anio double, edad double, sexo string, vacio string",
    )
    found = profile.variable_profile(df, descriptions={"edad": "Edad"})
    got = {r["column"]: r for r in found.collect()}
    assert got["edad"]["description"] == "Edad"
    assert (got["sexo"]["n_unique"], got["sexo"]["pct_null"]) == (1, 50.0)
    assert (got["vacio"]["n_unique"], got["vacio"]["n_null"]) == (0, 10)
    assert rows(profile.select_columns(found, "categorical", 1, 5, 0.4), "column") == [("sexo",)]
    flagged = profile.identifier_like(df, ["anio", "edad"]).where("is_identifier")
    assert rows(flagged, "column") == [("anio",)]


def test_relative_change_golden(spark):
    counts = spark.createDataFrame([(2012, 7121), (2021, 5075)], "_year int, n long")
    change = frequency.relative_change(counts, "_year", 2012, 2021).first()["pct_change"]
    assert change == pytest.approx(-28.73, abs=0.01)


def test_silhouette_golden(spark):
    points = [([0.0], 0), ([1.0], 0), ([10.0], 1), ([11.0], 1), ([30.0], 2)]
    df = spark.createDataFrame(points, "features array<double>, label int")
    got = clustering.exact_silhouette(df, ["label"]).first()["silhouette"]
    assert got == pytest.approx(0.719799, abs=1e-6)
    with pytest.raises(ValueError):
        clustering.exact_silhouette(df, ["label"], limit=4)


def test_silhouette_takes_all_points(spark):
    """More points than the former limit of 10,000, in many blocks, against sums over sorted distances."""
    import numpy as np

    rng = np.random.default_rng(3)
    x = rng.normal(size=10_500) + np.arange(10_500) % 3
    frame = spark.createDataFrame(
        [([float(v), 7.0], i % 3, i % 2) for i, v in enumerate(x)], "features array<double>, a int, b int"
    )
    got = {r["labelling"]: r["silhouette"] for r in clustering.exact_silhouette(frame, ["a", "b"]).collect()}
    for name, label in (("a", np.arange(len(x)) % 3), ("b", np.arange(len(x)) % 2)):
        means = []
        for c in np.unique(label):
            y = np.sort(x[label == c])
            run, at = np.append(0, np.cumsum(y)), np.searchsorted(y, x)
            total = x * at - run[at] + (run[-1] - run[at]) - x * (len(y) - at)
            means.append((total / (len(y) - (label == c))))
        means = np.array(means)
        inside = means[label, np.arange(len(x))]
        means[label, np.arange(len(x))] = np.inf
        nearest = means.min(0)
        assert got[name] == pytest.approx(((nearest - inside) / np.maximum(nearest, inside)).mean(), abs=1e-7)


def test_best_k_golden(spark):
    scores = (0.1190, 0.1332, 0.1353, 0.1499, 0.1274, 0.1037, 0.1045)
    sweep = spark.createDataFrame([(k, s) for k, s in enumerate(scores, start=2)], "k int, silhouette double")
    assert clustering.best_k(sweep).first()["k"] == 5
    tied = spark.createDataFrame([(2, 0.5), (3, 0.5)], "k int, silhouette double")
    assert clustering.best_k(tied).first()["k"] == 2


def test_cluster_names_golden(spark):
    df = spark.createDataFrame(
        [(6.1, "x"), (38.5, "x"), (60.6, "Médica"), (63.7, "Ninguna"), (13.0, "x"), (60.0, "Paramédica")],
        "age double, asist string",
    )
    got = [r[0] for r in df.select(clustering.semantic_name(F.col("age"), F.col("asist"))).collect()]
    assert got == [
        "Mortalidad Infantil/Neonatal",
        "Riesgo Joven / Edad Productiva",
        "Adultos Mayores (Con Asistencia)",
        "Adultos Mayores (Sin Asistencia)",
        "Mortalidad Adulta General",
        "Adultos Mayores (Sin Asistencia)",
    ]


@pytest.fixture()
def blobs(spark):
    data = [(i, float(i % 3) * 50 + (i % 7) * 0.1, "abc"[i % 3]) for i in range(300)]
    return spark.createDataFrame([*data, (300, None, "a")], "id long, x double, c string")


def test_segmentation_finds_blobs(blobs):
    encoded, features = clustering.one_hot(blobs, ["x"], ["c"], keep=["id"])
    assert features == ["x", "c_a", "c_b", "c_c"]
    scaled = clustering.standardise(encoded, features)
    stats = scaled.agg(F.avg("x").alias("m"), F.stddev_pop("x").alias("s")).first()
    assert stats["m"] == pytest.approx(0, abs=1e-9) and stats["s"] == pytest.approx(1)
    vectors = clustering.to_vectors(scaled, features, ["id"]).persist()
    sweep = clustering.sweep_k(vectors, ks=(2, 3, 4), n_init=2, key=["id"])
    assert clustering.best_k(sweep).first()["k"] == 3
    placed, _ = clustering.assign_clusters(vectors, 3, n_init=2)
    groups = placed.join(blobs, "id").groupBy("cluster", "c").count().collect()
    assert len(groups) == 3 and {r["count"] for r in groups} == {100}


@pytest.mark.parametrize("name", ["kmeans_sweep", "best_k", "kmeans_final"])
def test_search_covers_its_range(spark, monkeypatch, name):
    """The registered searches try k = 2..8 with ten starts over all rows; the final fit takes the chosen k."""
    from suite import q_cluster

    data = [(i, i % 7, [float(i % 7 == j) * 40 + i % 3 * 0.1 for j in range(7)]) for i in range(210)]
    frame = spark.createDataFrame(data, "vec_id long, label int, embedding array<float>")
    monkeypatch.setattr(q_cluster, "table", lambda *_: frame)
    features = [f"f{i}" for i in range(7)]
    wide = frame.select("vec_id", *[F.get("embedding", F.lit(i)).cast("double").alias(f) for i, f in enumerate(features)])
    monkeypatch.setattr(q_cluster, "_scaled", lambda *_: (wide, features))
    tried, fit = [], clustering.fit_kmeans

    def quick(vectors, k, n_init=10, seed=42, parallelism=4):
        tried.append((k, n_init, vectors.count()))
        return fit(vectors, k, 3, seed, 3)

    monkeypatch.setattr(clustering, "fit_kmeans", quick)
    got = getattr(q_cluster, name)(spark, "").collect()
    assert tried[:7] == [(k, 10, 210) for k in range(2, 9)]
    if name == "kmeans_sweep":
        assert [r["k"] for r in got] == list(range(2, 9))
    if name == "best_k":
        assert got[0]["k"] == 7
    if name == "kmeans_final":
        assert tried[7:] == [(7, 10, 210)] and [r["n"] for r in got] == [30] * 7


def test_sweep_takes_all_rows_unless_asked(spark):
    vectors = clustering.to_vectors(spark.range(60_000).selectExpr("id", "double(id % 2) AS x"), ["x"], ["id"])
    cost = clustering.sweep_k(vectors, ks=(2,), n_init=1).first()
    assert cost["inertia"] == pytest.approx(0, abs=1e-6)
    one = clustering.to_vectors(spark.range(60_000).selectExpr("id", "double(id) AS x"), ["x"], ["id"])
    whole = clustering.sweep_k(one, ks=(2,), n_init=1).first()["inertia"]
    part = clustering.sweep_k(one, ks=(2,), n_init=1, key=["id"], sample_n=600).first()["inertia"]
    assert whole == pytest.approx(2 * 30_000**3 / 12, rel=0.01) and part < whole / 50


def test_projection_matches_numpy(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 3)) @ np.array([[3, 0, 0], [1, 1, 0], [0, 0, 0.2]])
    x = x - x.mean(axis=0)
    df = spark.createDataFrame([(r.tolist(),) for r in x], "a array<double>")
    from pyspark.ml.functions import array_to_vector

    projected, shares = clustering.project_2d(df.select(array_to_vector("a").alias("features")))
    values = np.linalg.eigvalsh(np.cov(x.T))[::-1]
    assert shares == pytest.approx((values / values.sum())[:2].tolist(), rel=1e-6)
    spread = projected.agg(F.var_samp("pc1")).first()[0]
    assert spread == pytest.approx(values[0], rel=1e-6)


def test_too_many_levels_is_refused(spark):
    df = spark.range(100).selectExpr("CAST(id AS string) AS c")
    with pytest.raises(ValueError):
        clustering.category_levels(df, ["c"])
