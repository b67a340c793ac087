"""Registered queries: features, k-means, silhouette, projection and cluster profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from suite.facts import deaths, deaths_sql, table
from suite.registry import query, rounded
from vitalframe.operators import clustering, kmeans_search, profile

_NUMERIC, _CATEGORICAL = ("edadif", "diaocu"), ("sexo", "areag", "escodif")


def _scaled(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[str]]:
    register = deaths(spark, sf_dir, *_NUMERIC, *_CATEGORICAL)
    encoded, features = clustering.one_hot(register, _NUMERIC, _CATEGORICAL)
    return clustering.standardise(encoded, features), features


_LEVELS = {
    "sexo": ("Hombre", "Mujer"),
    "areag": ("Ignorado", "Rural", "Urbano"),
    "escodif": ("Básico", "Diversificado", "Ninguna", "Primaria", "Universitario"),
}
_FEATURES = {
    **{c: c for c in _NUMERIC},
    **{f"{c}_{v}": f"CASE WHEN {c} = '{v}' THEN 1.0 ELSE 0.0 END" for c in _CATEGORICAL for v in _LEVELS[c]},
}


@query(
    f"WITH {deaths_sql(*_NUMERIC, *_CATEGORICAL)}, complete AS (SELECT * FROM deaths WHERE "
    + " AND ".join(f"{c} IS NOT NULL" for c in (*_NUMERIC, *_CATEGORICAL))
    + ") "
    + " UNION ALL ".join(
        f"""SELECT '{name}' AS feature, count(*) AS n, CAST(0 AS DOUBLE) AS mean, CAST(1 AS DOUBLE) AS std,
        round(avg(pow((({e}) - m) / s, 3)), 4) AS third FROM complete,
        (SELECT avg({e}) AS m, stddev_pop({e}) AS s FROM complete)"""
        for name, e in _FEATURES.items()
    )
)
def onehot_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean, deviation and third moment of every standardised feature."""
    scaled, features = _scaled(spark, sf_dir)
    stats = {
        c: F.struct(
            F.lit(c).alias("feature"),
            F.count(F.lit(1)).alias("n"),
            F.avg(f"`{c}`").alias("mean"),
            F.stddev_pop(f"`{c}`").alias("std"),
            F.avg(F.pow(F.col(f"`{c}`"), 3)).alias("third"),
        )
        for c in features
    }
    return rounded(profile.per_column(scaled, stats))


def _points(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[str]]:
    """Standardised embedding vectors."""
    embedded = table(spark, sf_dir, "embeddings")
    width = F.size("embedding")
    size = embedded.agg(F.max(width)).first()[0]
    features = [f"f{i}" for i in range(size)]
    wide = embedded.select(
        "vec_id", "label", *[F.get("embedding", F.lit(i)).cast("double").alias(f) for i, f in enumerate(features)]
    )
    return clustering.standardise(wide, features), features


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled, features = _points(spark, sf_dir)
    return clustering.to_vectors(scaled, features, ["vec_id", "label"])


@query()
def kmeans_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inertia and squared-distance silhouette for k = 2..8 over all rows, best of ten starts."""
    return clustering.sweep_k(_vectors(spark, sf_dir))


@query()
def best_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The k of 2..8 with the highest silhouette over all rows, ten starts each."""
    return clustering.best_k(clustering.sweep_k(_vectors(spark, sf_dir)))


@query()
def kmeans_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster sizes of the fit over all rows of the mixed death features, with the best k of 2..8."""
    scaled, features = _scaled(spark, sf_dir)
    vectors = clustering.to_vectors(scaled, features)
    k = clustering.best_k(clustering.sweep_k(vectors)).first()["k"]
    sizes = clustering.cluster_sizes(vectors, clustering.fit_kmeans(vectors, k))
    total = sizes.agg(F.sum("n")).scalar()
    return sizes.withColumn("pct", F.col("n") / total * 100)


@query("SELECT CAST(unnest(range(2, 9)) AS INT) AS k, 10 AS starts, (SELECT count(*) FROM embeddings) AS n_rows, true AS falls, true AS in_range")
def kmeans_joint_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """k = 2..8 with ten starts over all embeddings, trained together: what must hold of the result for each k.

    The rows in its clusters, that its cost is not above that of the k before by more than a start's luck (1 %), and that its
    silhouette is one.
    """
    best = kmeans_search.search_points(kmeans_search.pooled(_vectors(spark, sf_dir)))
    before = [best[0].cost, *[m.cost for m in best]]
    rows = [
        (m.k, 10, int(m.sizes.sum()), m.cost <= 1.01 * b, m.silhouette is None or -1 <= m.silhouette <= 1) for m, b in zip(best, before)
    ]
    return spark.createDataFrame(rows, "k int, starts int, n_rows long, falls boolean, in_range boolean")


@query()
def kmeans_joint_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster sizes of the chosen model of the search over the mixed death features; it is not fitted again."""
    scaled, features = _scaled(spark, sf_dir)
    vectors = clustering.to_vectors(scaled, features)
    best = kmeans_search.search_points(clustering.pooled(vectors))
    sizes = clustering.cluster_sizes(vectors, kmeans_search.chosen(best))
    total = sizes.agg(F.sum("n")).scalar()
    return sizes.withColumn("pct", F.col("n") / total * 100)


@query()
def pca_2d(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two components of the embeddings with the share of variance they explain."""
    projected, shares = clustering.project_2d(_vectors(spark, sf_dir))
    return projected.select(
        "vec_id", "pc1", "pc2", F.lit(shares[0]).alias("share1"), F.lit(shares[1]).alias("share2")
    )


def _silhouette_sql(distance: str) -> str:
    """Mean silhouette by comparing every pair of points."""
    return f"""WITH p AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
    d AS (SELECT x.vec_id, x.label AS own, y.label AS other, sum({distance}) AS total, count(*) AS n
      FROM p x, p y WHERE x.vec_id <> y.vec_id GROUP BY 1, 2, 3),
    m AS (SELECT vec_id, coalesce(max(total / n) FILTER (own = other), 0) AS a,
      min(total / n) FILTER (own <> other) AS b, max(n) FILTER (own = other) AS mates FROM d GROUP BY 1)
    SELECT round(avg(CASE WHEN mates IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 6)
      AS silhouette FROM m"""


@query(_silhouette_sql("list_distance(x.e, y.e)"))
def silhouette_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Euclidean silhouette of the given labels, every point against all."""
    embedded = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("features"), "label"
    )
    scored = clustering.exact_silhouette(embedded, ["label"])
    return scored.select(F.round("silhouette", 6).alias("silhouette"))


@query(_silhouette_sql("pow(list_distance(x.e, y.e), 2)"))
def silhouette_squared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Squared Euclidean silhouette of the given labels over all points."""
    from pyspark.ml.functions import array_to_vector

    embedded = table(spark, sf_dir, "embeddings").select(
        array_to_vector(F.col("embedding").cast("array<double>")).alias("features"),
        F.col("label").cast("double").alias("prediction"),
    )
    score = clustering.squared_silhouette(embedded)
    return spark.createDataFrame([(round(score, 6),)], "silhouette double")


_GROUPED = ("_year", "edadif", "diaocu", "sexo", "asist", "areag")


def _clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deaths with their year standing in for a cluster number."""
    return deaths(spark, sf_dir, *_GROUPED).withColumnRenamed("_year", "cluster")


_CLUSTERED_SQL = f"{deaths_sql(*_GROUPED)}, c AS (SELECT _year AS cluster, * EXCLUDE (_year) FROM deaths)"


@query(
    f"WITH {_CLUSTERED_SQL} "
    + " UNION ALL ".join(
        f"""SELECT k.cluster, '{v}' AS "column", l.{v} AS value,
        round(100.0 * coalesce(n, 0) / sum(coalesce(n, 0)) OVER (PARTITION BY k.cluster), 4) AS pct
        FROM (SELECT DISTINCT cluster FROM c) k CROSS JOIN (SELECT DISTINCT {v} FROM c WHERE {v} IS NOT NULL) l
        LEFT JOIN (SELECT cluster, {v}, count(*) AS n FROM c GROUP BY 1, 2) g
          ON g.cluster = k.cluster AND g.{v} = l.{v}"""
        for v in ("sexo", "asist", "areag")
    )
)
def cluster_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(clustering.cluster_profile(_clustered(spark, sf_dir), ("sexo", "asist", "areag")))


@query(
    f"""WITH {_CLUSTERED_SQL} SELECT cluster, round(avg(edadif), 4) AS edadif,
      round(avg(diaocu), 4) AS diaocu FROM c GROUP BY 1"""
)
def cluster_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(clustering.cluster_means(_clustered(spark, sf_dir), ("edadif", "diaocu")))


# Group keys spread the ages so that every naming rule applies.
_AGE_SHIFT = "edadif + CASE WHEN cluster < 2013 THEN -20 WHEN cluster > 2015 THEN 25 WHEN cluster = 2014 THEN -12 ELSE 0 END"


@query(
    f"""WITH {_CLUSTERED_SQL}, shifted AS (SELECT cluster, {_AGE_SHIFT} AS edadif, sexo,
      CASE WHEN cluster = 2018 AND asist IS NOT NULL THEN 'Médica' ELSE asist END AS asist FROM c),
    a AS (SELECT cluster, asist, row_number() OVER (PARTITION BY cluster ORDER BY count(*) DESC, asist) r
      FROM shifted WHERE asist IS NOT NULL GROUP BY 1, 2),
    s AS (SELECT cluster, sexo, row_number() OVER (PARTITION BY cluster ORDER BY count(*) DESC, sexo) r
      FROM shifted WHERE sexo IS NOT NULL GROUP BY 1, 2),
    m AS (SELECT cluster, avg(edadif) AS age FROM shifted GROUP BY 1)
    SELECT cluster, CASE WHEN age < 12 THEN 'Mortalidad Infantil/Neonatal'
      WHEN age BETWEEN 15 AND 45 THEN 'Riesgo Joven / Edad Productiva'
      WHEN age > 45 THEN 'Adultos Mayores (' || CASE WHEN contains(a.asist, 'Médica')
        THEN 'Con Asistencia' ELSE 'Sin Asistencia' END || ')'
      ELSE 'Mortalidad Adulta General' END AS name, round(age, 4) AS mean_age,
      s.sexo AS sex, a.asist AS assistance
    FROM m JOIN a USING (cluster) JOIN s USING (cluster) WHERE a.r = 1 AND s.r = 1"""
)
def cluster_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    shifted = _clustered(spark, sf_dir).selectExpr(
        "cluster",
        f"{_AGE_SHIFT} AS edadif",
        "sexo",
        "CASE WHEN cluster = 2018 AND asist IS NOT NULL THEN 'Médica' ELSE asist END AS asist",
    )
    return rounded(clustering.cluster_names(shifted))


@query()
def cluster_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns chosen for clustering from the variable profile."""
    cols = ("edadif", "diaocu", "anioocu", "sexo", "areag", "asist", "mesocu", "depocu", "escodif", "ocur")
    register = deaths(spark, sf_dir, *cols)
    found = profile.variable_profile(register, cols)
    flagged = profile.identifier_like(register, ("edadif", "diaocu", "anioocu")).where("is_identifier")
    identifiers = [r["column"] for r in flagged.collect()]
    numeric, categorical = clustering.choose_features(found, identifiers)
    rows = [(c, "numeric") for c in numeric] + [(c, "categorical") for c in categorical]
    return spark.createDataFrame(rows, "feature string, kind string")
