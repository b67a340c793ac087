"""Registered queries: hypothesis tests and the five composed analyses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from suite.facts import deaths, deaths_sql, table
from suite.q_query import MEASURES
from suite.registry import query, rounded
from vitalframe.operators import association, crosstab, normality
from vitalframe.operators.counts import midranks, value_counts
from vitalframe.plans import hypotheses


def _chi2_tail_sql(statistic: str, dof: str) -> str:
    """Upper tail of chi-square as 1 minus the series of the lower incomplete gamma function."""
    a, x = f"({dof} / 2.0)", f"greatest({statistic} / 2.0, 1e-12)"
    term = f"exp(({a} + i) * ln({x}) - {x} - lgamma({a} + i + 1))"
    return f"(1 - list_sum(list_transform(range(0, 400), lambda i: {term})))"


def _test_sql(name: str, stats: str) -> str:
    """Test row from a CTE ``stats(n, statistic, dof)``; p is only compared where it is not tiny."""
    p = _chi2_tail_sql("statistic", "dof")
    return f"""{stats}, tested AS (SELECT *, CASE WHEN statistic < 300 THEN greatest({p}, 0) ELSE 0 END
      AS p FROM stats)
    SELECT '{name}' AS test, CAST(n AS BIGINT) AS n, round(statistic, 4) AS statistic,
      CAST(dof AS BIGINT) AS dof, round(p, 6) AS p_value, p < 0.05 AS reject FROM tested"""


def _test_row(df: DataFrame) -> DataFrame:
    return df.select(
        "test", "n", F.round("statistic", 4).alias("statistic"), "dof",
        F.round("p_value", 6).alias("p_value"), "reject",
    )


def _chi2_sql(cells: str, row: str, col: str) -> str:
    """Statistic from observed and expected counts, cell by cell, zero cells included."""
    return f"""cells AS ({cells}),
    r AS (SELECT {row}, sum(n) AS rt FROM cells GROUP BY 1),
    c AS (SELECT {col}, sum(n) AS ct FROM cells GROUP BY 1),
    g AS (SELECT rt, ct, coalesce(n, 0) AS o, rt * ct / (SELECT sum(n) FROM cells) AS e
      FROM r CROSS JOIN c LEFT JOIN cells USING ({row}, {col})),
    d AS (SELECT ((SELECT count(*) FROM r) - 1) * ((SELECT count(*) FROM c) - 1) AS dof),
    stats AS (SELECT sum(o) AS n, any_value(dof) AS dof,
      sum(pow(abs(o - e) - CASE WHEN dof = 1 THEN least(0.5, abs(o - e)) ELSE 0 END, 2) / e)
      AS statistic FROM g, d)"""


_ASIST_AREA = """SELECT areag, asist, count(*) AS n FROM deaths
    WHERE areag IS NOT NULL AND asist IS NOT NULL GROUP BY 1, 2"""


@query(_test_sql("chi2", f"WITH {deaths_sql('areag', 'asist')}, {_chi2_sql(_ASIST_AREA, 'areag', 'asist')}"))
def chi2_independence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _test_row(association.chi2_of_columns(deaths(spark, sf_dir, "areag", "asist"), "areag", "asist"))


_SPARSE = "SELECT p_name, p_brand, count(*) AS n FROM part GROUP BY 1, 2"


@query(_test_sql("chi2", f"WITH {_chi2_sql(_SPARSE, 'p_name', 'p_brand')}").replace("statistic < 300", "statistic < 5000").replace("range(0, 400)", "range(0, 3000)"))
def chi2_many_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A wide table with empty cells and many degrees of freedom."""
    return _test_row(association.chi2_of_columns(table(spark, sf_dir, "part"), "p_name", "p_brand"))


_SEX_PERIOD = """SELECT sexo, kind, count(*) AS n FROM (SELECT sexo, CASE WHEN perdif IN
    ('Menos De Un Mes', '1 A 11 Meses') THEN 'infantil' ELSE 'otras' END AS kind FROM deaths)
    WHERE sexo IS NOT NULL GROUP BY 1, 2"""


@query(_test_sql("chi2", f"WITH {deaths_sql('sexo', 'perdif')}, {_chi2_sql(_SEX_PERIOD, 'sexo', 'kind')}"))
def chi2_2x2_yates(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(hypotheses.infant(), "infantil").otherwise("otras")
    register = deaths(spark, sf_dir, "sexo", "perdif").withColumn("kind", kind)
    return _test_row(association.chi2_of_columns(register, "sexo", "kind"))


@query(
    f"""WITH {deaths_sql('areag', 'asist')}, cells AS ({_ASIST_AREA}),
    r AS (SELECT areag, sum(n) AS rt FROM cells GROUP BY 1),
    c AS (SELECT asist, sum(n) AS ct FROM cells GROUP BY 1)
    SELECT areag, asist, coalesce(n, 0) AS n, round(CAST(rt * ct AS DOUBLE) / (SELECT sum(n) FROM cells), 4)
      AS expected FROM r CROSS JOIN c LEFT JOIN cells USING (areag, asist)"""
)
def expected_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    observed = crosstab.cells(deaths(spark, sf_dir, "areag", "asist"), "areag", "asist")
    return rounded(association.expected_counts(observed, "areag", "asist"))


def _kruskal_sql(source: str, group: str, value: str) -> str:
    return f"""present AS (SELECT {group} AS g, {value} AS x FROM {source}
      WHERE {group} IS NOT NULL AND {value} IS NOT NULL),
    ranked AS (SELECT g, x, rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS r
      FROM present),
    sums AS (SELECT g, sum(r) AS rs, count(*) AS c FROM ranked GROUP BY g),
    ties AS (SELECT sum(CAST(c AS DOUBLE) * c * c - c) AS t
      FROM (SELECT count(*) AS c FROM present GROUP BY x)),
    stats AS (SELECT sum(c) AS n, count(*) - 1 AS dof,
      (12.0 / (CAST(sum(c) AS DOUBLE) * (sum(c) + 1)) * sum(rs * rs / c) - 3 * (CAST(sum(c) AS DOUBLE) + 1))
      / (1 - (SELECT t FROM ties) / (pow(CAST(sum(c) AS DOUBLE), 3) - sum(c))) AS statistic FROM sums)"""


@query(
    _test_sql("kruskal", f"WITH {deaths_sql('escodif', 'edadif')}, {_kruskal_sql('deaths', 'escodif', 'edadif')}")
)
def kruskal_wallis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _test_row(hypotheses.schooling_test(deaths(spark, sf_dir, "escodif", "edadif")))


@query(
    _test_sql("kruskal", f"WITH {_kruskal_sql('events', 'event_type', 'value')}")
)
def kruskal_continuous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearly every value distinct: ranks run over many slices."""
    types = ("signup", "error", "click", "view", "purchase")
    events = table(spark, sf_dir, "events")
    return _test_row(association.kruskal_wallis(events, "event_type", "value", types))


@query(
    """SELECT value, n, total, before, CAST(before AS DOUBLE) + (n + 1) / 2.0 AS midrank FROM (
      SELECT value, n, CAST(sum(n) OVER () AS BIGINT) AS total,
        CAST(coalesce(sum(n) OVER (ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
          AS BIGINT) AS before
      FROM (SELECT value, count(*) AS n FROM events GROUP BY 1))"""
)
def midrank_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Average rank of every distinct value."""
    return midranks(value_counts(table(spark, sf_dir, "events"), "value"), "value")


def _z_sql(source: str, condition: str, p0: float) -> str:
    q = _chi2_tail_sql("(statistic * statistic)", "1")
    return f"""stats AS (SELECT count(*) AS n, count(*) FILTER ({condition}) AS hits,
      count(*) FILTER ({condition}) / count(*) AS p_hat,
      (count(*) FILTER ({condition}) / count(*) - {p0}) / sqrt({p0} * (1 - {p0}) / count(*)) AS statistic
      FROM {source}),
    tested AS (SELECT *, CASE WHEN abs(statistic) > 15 THEN CASE WHEN statistic > 0 THEN 0 ELSE 1 END
      WHEN statistic > 0 THEN {q} / 2 ELSE 1 - {q} / 2 END AS p FROM stats)
    SELECT 'proportion_z' AS test, n, hits, round(p_hat, 4) AS p_hat,
      round(statistic, 4) AS statistic, round(p, 6) AS p_value, p < 0.05 AS reject FROM tested"""


def _z_row(df: DataFrame) -> DataFrame:
    return df.select(
        "test", "n", "hits", F.round("p_hat", 4).alias("p_hat"),
        F.round("statistic", 4).alias("statistic"), F.round("p_value", 6).alias("p_value"), "reject",
    )


_STREET = "street AS (SELECT * FROM deaths WHERE lower(ocur) LIKE '%pública%')"
_YOUNG_MAN = "sexo = 'Hombre' AND edadif BETWEEN 15 AND 40"


@query(
    f"WITH {deaths_sql('ocur', 'sexo', 'edadif')}, {_STREET}, {_z_sql('street', _YOUNG_MAN, 0.25)}"
)
def prop_z_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _z_row(hypotheses.street_test(deaths(spark, sf_dir, "ocur", "sexo", "edadif"), 0.25))


@query(
    f"""WITH {deaths_sql('asist', 'areag')} SELECT
      count(*) FILTER (asist = 'Ninguna' AND areag = 'Rural') AS hits,
      count(*) FILTER (areag = 'Rural') AS base,
      round(count(*) FILTER (asist = 'Ninguna' AND areag = 'Rural') / count(*) FILTER (areag = 'Rural'), 4)
      AS share FROM deaths"""
)
def share_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(hypotheses.area_share(deaths(spark, sf_dir, "asist", "areag"), "Rural"))


_GAP_SQL = """SELECT round(a, 4) AS rate_a, round(b, 4) AS rate_b, round(a / b, 4) AS ratio FROM (
    SELECT count(*) FILTER (asist = 'Ninguna' AND areag = 'Rural') / count(*) FILTER (areag = 'Rural') AS a,
      count(*) FILTER (asist = 'Ninguna' AND areag = 'Urbano') / count(*) FILTER (areag = 'Urbano') AS b
    FROM deaths)"""


@query(f"WITH {deaths_sql('asist', 'areag')} {_GAP_SQL}")
def rate_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(hypotheses.area_gap(deaths(spark, sf_dir, "asist", "areag")))


@query()
def shapiro_by_variable(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = deaths(spark, sf_dir, "edadif", "diaocu", "libras", "l_orderkey", "l_linenumber")
    return normality.shapiro_wilk(
        keyed, ("edadif", "diaocu", "libras"), key=["l_orderkey", "l_linenumber"]
    )


@query(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", n, round(jb, 2) AS statistic, round(exp(-jb / 2), 6) AS p_value,
        exp(-jb / 2) > 0.05 AS normal FROM (SELECT n, n / 6.0 * (g1 * g1 + g2 * g2 / 4) AS jb FROM (
          SELECT count({c}) AS n, avg(pow({c} - m, 3)) / pow(avg(pow({c} - m, 2)), 1.5) AS g1,
            avg(pow({c} - m, 4)) / pow(avg(pow({c} - m, 2)), 2) - 3 AS g2
          FROM lineitem, (SELECT avg({c}) AS m FROM lineitem)))"""
        for c in MEASURES
    )
)
def jarque_bera(spark: SparkSession, sf_dir: str) -> DataFrame:
    tested = normality.jarque_bera(table(spark, sf_dir, "lineitem"), MEASURES)
    return tested.select(
        "column", "n", F.round("statistic", 2).alias("statistic"),
        F.round("p_value", 6).alias("p_value"), "normal",
    )


# --- Composed analyses ----------------------------------------------------------------------

_COVID = "SELECT * FROM deaths WHERE caudef LIKE 'U07%'"
_CAUSE_CELLS = f"""SELECT depocu, CASE WHEN asist = 'Ninguna' THEN 'Sin' ELSE 'Con' END AS k, count(*) AS n
    FROM ({_COVID}) WHERE depocu IS NOT NULL GROUP BY 1, 2"""
_CAUSE = ("depocu", "asist", "caudef")


@query(_test_sql("chi2", f"WITH {deaths_sql(*_CAUSE)}, {_chi2_sql(_CAUSE_CELLS, 'depocu', 'k')}"))
def h1_cause_by_department(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _test_row(hypotheses.cause_test(deaths(spark, sf_dir, *_CAUSE)))


@query(
    f"""WITH {deaths_sql(*_CAUSE)} SELECT depocu, count(*) AS n,
      count(*) FILTER (asist = 'Ninguna') AS n_without,
      round(100.0 * count(*) FILTER (asist = 'Ninguna') / count(*), 4) AS pct_without
    FROM ({_COVID}) WHERE depocu IS NOT NULL GROUP BY 1"""
)
def h1_department_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(hypotheses.cause_ranking(deaths(spark, sf_dir, *_CAUSE)))


@query(
    f"""WITH {deaths_sql('escodif', 'edadif')} SELECT CAST(position AS INT) AS position, escodif,
      n, median FROM (SELECT escodif, count(edadif) AS n, quantile_cont(edadif, 0.5) AS median
      FROM deaths WHERE escodif IS NOT NULL GROUP BY 1) JOIN (VALUES (0, 'Ninguna'), (1, 'Primaria'),
      (2, 'Básico'), (3, 'Diversificado'), (4, 'Universitario')) v(position, escodif) USING (escodif)"""
)
def h2_age_by_schooling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hypotheses.schooling_medians(deaths(spark, sf_dir, "escodif", "edadif"))


_INFANT = "perdif IN ('Menos De Un Mes', '1 A 11 Meses')"
_INFANT_CELLS = f"""SELECT _year, CASE WHEN {_INFANT} THEN 'i' ELSE 'o' END AS k, count(*) AS n
    FROM deaths WHERE _year IN (2012, 2018) GROUP BY 1, 2"""


@query(_test_sql("chi2", f"WITH {deaths_sql('_year', 'perdif')}, {_chi2_sql(_INFANT_CELLS, '_year', 'k')}"))
def h3_infant_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _test_row(hypotheses.infant_test(deaths(spark, sf_dir, "_year", "perdif"), 2012, 2018))


@query(
    f"""WITH {deaths_sql('_year', 'perdif')} SELECT _year, count(*) AS total,
      count(*) FILTER ({_INFANT}) AS infantil,
      round(100.0 * count(*) FILTER ({_INFANT}) / count(*), 4) AS pct FROM deaths GROUP BY 1"""
)
def h3_infant_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(hypotheses.infant_shares(deaths(spark, sf_dir, "_year", "perdif")))


@query(
    f"""WITH {deaths_sql('_year', 'perdif')} SELECT _year, count(*) AS n FROM deaths WHERE {_INFANT}
    GROUP BY 1"""
)
def h3_infant_national(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hypotheses.infant_national(deaths(spark, sf_dir, "_year", "depocu", "perdif"))


@query(
    f"""WITH {deaths_sql('ocur', 'sexo', 'edadif')}, {_STREET}, s AS (SELECT count(*) AS a,
      count(*) FILTER (sexo = 'Hombre') AS m, count(*) FILTER ({_YOUNG_MAN}) AS y FROM street)
    SELECT 'men' AS measure, m AS hits, a AS base, round(m / a, 4) AS share FROM s
    UNION ALL SELECT 'young_men', y, a, round(y / a, 4) FROM s
    UNION ALL SELECT 'young_among_men', y, m, round(y / m, 4) FROM s"""
)
def h4_street_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(hypotheses.street_shares(deaths(spark, sf_dir, "ocur", "sexo", "edadif")))


@query(f"WITH {deaths_sql('ocur', 'sexo', 'edadif')}, {_STREET}, {_z_sql('street', _YOUNG_MAN, 0.5)}")
def h4_street_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _z_row(hypotheses.street_test(deaths(spark, sf_dir, "ocur", "sexo", "edadif")))


@query(
    f"""WITH {deaths_sql('ocur', 'sexo', 'edadif')}, {_STREET},
    s AS (SELECT sexo, count(edadif) AS n, stddev_samp(edadif) * pow(count(edadif), -0.2) AS h, min(edadif) AS lo,
      max(edadif) AS hi FROM street WHERE sexo IS NOT NULL GROUP BY 1 HAVING stddev_samp(edadif) > 0),
    v AS (SELECT sexo, edadif AS v, count(*) AS c FROM street WHERE sexo IS NOT NULL AND edadif IS NOT NULL GROUP BY 1, 2),
    g AS (SELECT sexo, n, h, CAST(i AS INT) AS i, lo - 3 * h + i * ((hi - lo + 6 * h) / 199) AS x
      FROM s, (SELECT unnest(range(200)) AS i))
    SELECT sexo, i, round(x, 4) AS x,
      round(sum(c * exp(-pow((x - v) / h, 2) / 2)) / (any_value(n) * any_value(h) * sqrt(2 * pi())), 6) AS density
    FROM g JOIN v USING (sexo) GROUP BY sexo, i, x"""
)
def h4_street_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Age at death in public places, a curve for each sex."""
    curve = hypotheses.street_density(deaths(spark, sf_dir, "ocur", "sexo", "edadif"))
    return curve.select("sexo", "i", F.round("x", 4).alias("x"), F.round("density", 6).alias("density"))


_AREA_CELLS = """SELECT areag, CASE WHEN asist = 'Ninguna' THEN 'Sin' ELSE 'Con' END AS k,
    count(*) AS n FROM deaths WHERE areag IN ('Rural', 'Urbano') GROUP BY 1, 2"""


@query(_test_sql("chi2", f"WITH {deaths_sql('areag', 'asist')}, {_chi2_sql(_AREA_CELLS, 'areag', 'k')}"))
def h5_area_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _test_row(hypotheses.area_test(deaths(spark, sf_dir, "areag", "asist")))


@query(f"WITH {deaths_sql('asist', 'areag')} {_GAP_SQL}")
def h5_area_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(hypotheses.area_gap(deaths(spark, sf_dir, "asist", "areag")))


@query(
    f"""WITH {deaths_sql('areag', 'asist')}, {_chi2_sql(_AREA_CELLS, 'areag', 'k')}, t AS (
      SELECT CASE WHEN statistic < 300 THEN {_chi2_tail_sql('statistic', 'dof')} ELSE 0 END AS p FROM stats)
    SELECT CASE WHEN p < 0.05 THEN 'reject H0' ELSE 'keep H0' END AS at_5_percent,
      CASE WHEN p < 0.999999 THEN 'reject H0' ELSE 'keep H0' END AS at_any FROM t"""
)
def decision_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decision texts of one test at two levels."""
    tested = hypotheses.area_test(deaths(spark, sf_dir, "areag", "asist"))
    p = F.col("p_value")
    return tested.select(
        association.decision(p).alias("at_5_percent"), association.decision(p, 0.999999).alias("at_any")
    )
