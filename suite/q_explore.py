"""Registered queries: frequencies, crosstabs, charts, series, outliers, correlation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from suite.facts import deaths, deaths_sql, table
from suite.q_query import MEASURES
from suite.registry import query, rounded
from vitalframe.functions.text import contains_ignore_case
from vitalframe.operators import association, charts, crosstab, frequency, gram, outliers
from vitalframe.operators import counts
from vitalframe.operators.counts import count_by
from vitalframe.operators.sampling import sample_per_group
from vitalframe.plans import hypotheses

_FREQUENT = ("depocu", "asist", "areag", "mesocu", "ocur")


def _frequency_sql(cols: tuple[str, ...], top: int) -> str:
    counted = " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {c} AS value, count(*) AS n FROM deaths WHERE {c} IS NOT NULL
        GROUP BY {c}"""
        for c in cols
    )
    return f"""WITH {deaths_sql(*cols)}, counts AS ({counted}), ranked AS (
      SELECT "column", value, n, row_number() OVER w AS position,
        sum(n) OVER (PARTITION BY "column" ORDER BY n DESC, value
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
        sum(n) OVER (PARTITION BY "column") AS total, count(*) OVER (PARTITION BY "column") AS k
      FROM counts WINDOW w AS (PARTITION BY "column" ORDER BY n DESC, value))
    SELECT "column", CAST(position AS INT) AS position, value, n,
      round_even((CAST(n AS DOUBLE) / total * 100) * 100, 0) / 100 AS pct,
      round_even((CAST(cum AS DOUBLE) / total * 100) * 100, 0) / 100 AS cum_pct, k AS n_categories,
      CAST(greatest(k - {top}, 0) AS BIGINT) AS others
    FROM ranked WHERE position <= {top}"""


@query(_frequency_sql(_FREQUENT, 20))
def frequency_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frequency.frequency_table(deaths(spark, sf_dir, *_FREQUENT), _FREQUENT, top=20)


@query(
    f"""WITH {deaths_sql('depocu')}, top AS (SELECT depocu AS value, count(*) AS n FROM deaths
      WHERE depocu IS NOT NULL GROUP BY 1 ORDER BY n DESC, value LIMIT 20)
    SELECT value, n, round_even((CAST(n AS DOUBLE) / (SELECT sum(n) FROM top) * 100) * 10, 0) / 10 AS pct FROM top"""
)
def bar_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frequency.bar_data(deaths(spark, sf_dir, "depocu"), "depocu")


@query(
    """WITH e AS (SELECT min(l_extendedprice) AS a, max(l_extendedprice) AS b FROM lineitem),
    found AS (SELECT CAST(least(floor((l_extendedprice - a) / (b - a) * 30), 29) AS INT) AS bin,
      count(*) AS n FROM lineitem, e GROUP BY 1)
    SELECT CAST(r.bin AS INT) AS bin, round(a + r.bin * ((b - a) / 30), 4) AS lo,
      round(a + (r.bin + 1) * ((b - a) / 30), 4) AS hi, coalesce(n, 0) AS n
    FROM (SELECT unnest(range(30)) AS bin) r, e LEFT JOIN found ON r.bin = found.bin"""
)
def histogram_30(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(charts.histogram(table(spark, sf_dir, "lineitem"), "l_extendedprice"))


def _box_sql(source: str, col: str, by: str | None) -> str:
    key = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    join = f"JOIN q USING ({by})" if by else ", q"
    return f"""q AS (SELECT {key}quantile_cont({col}, 0.25) AS q1, quantile_cont({col}, 0.5) AS median,
      quantile_cont({col}, 0.75) AS q3, count({col}) AS n FROM {source} {group}),
    placed AS (SELECT {key}q.*{" EXCLUDE (" + by + ")" if by else ""}, {col} AS v
      FROM {source} {join} WHERE {col} IS NOT NULL)
    SELECT {key}n, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3,
      round(least(min(v) FILTER (v >= q1 - 1.5 * (q3 - q1)), q1), 4) AS whisker_lo,
      round(greatest(max(v) FILTER (v <= q3 + 1.5 * (q3 - q1)), q3), 4) AS whisker_hi,
      count(*) FILTER (v < q1 - 1.5 * (q3 - q1)) AS fliers_lo,
      count(*) FILTER (v > q3 + 1.5 * (q3 - q1)) AS fliers_hi
    FROM placed GROUP BY {key}n, q1, median, q3"""


@query(f"WITH {_box_sql('events', 'value', None)}")
def boxplot_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(charts.box_stats(table(spark, sf_dir, "events"), "value"))


@query(f"WITH {deaths_sql('escodif', 'edadif')}, {_box_sql('deaths', 'edadif', 'escodif')}")
def boxplot_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(hypotheses.schooling_boxes(deaths(spark, sf_dir, "escodif", "edadif")))


@query(
    """WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3
      FROM events GROUP BY 1)
    SELECT event_type, round(value, 4) AS value, count(*) AS n FROM events JOIN q USING (event_type)
    WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1) GROUP BY 1, 2"""
)
def box_fliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(charts.box_fliers(table(spark, sf_dir, "events"), "value", "event_type"))


@query(
    f"""WITH {deaths_sql('sexo', 'edadif')}, s AS (
      SELECT sexo, count(edadif) AS n, stddev_samp(edadif) * pow(count(edadif), -0.2) AS h,
        min(edadif) AS lo, max(edadif) AS hi FROM deaths WHERE sexo IS NOT NULL GROUP BY 1),
    v AS (SELECT sexo, edadif AS v, count(*) AS c FROM deaths
      WHERE sexo IS NOT NULL AND edadif IS NOT NULL GROUP BY 1, 2),
    g AS (SELECT sexo, n, h, CAST(i AS INT) AS i, lo - 3 * h + i * ((hi - lo + 6 * h) / 199) AS x
      FROM s, (SELECT unnest(range(200)) AS i))
    SELECT sexo, i, round(x, 4) AS x,
      round(sum(c * exp(-pow((x - v) / h, 2) / 2)) / (any_value(n) * any_value(h) * sqrt(2 * pi())), 6)
      AS density FROM g JOIN v USING (sexo) GROUP BY sexo, i, x"""
)
def kde_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    curve = charts.density_curve(deaths(spark, sf_dir, "sexo", "edadif"), "edadif", "sexo")
    return curve.select("sexo", "i", F.round("x", 4).alias("x"), F.round("density", 6).alias("density"))


def _pairs_sql(cols: tuple[str, ...], source: str, digits: int) -> list[str]:
    from itertools import combinations

    return [
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), {digits}) AS r FROM {source}"
        for a, b in combinations(cols, 2)
    ]


_AGE_COLUMNS = ("edadif", "diaocu", "anioocu", "libras")


@query(f"WITH {deaths_sql(*_AGE_COLUMNS)} " + " UNION ALL ".join(_pairs_sql(_AGE_COLUMNS, "deaths", 4)[:6]))
def scatter_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Correlation of each plotted pair over all complete rows; one column has NULLs."""
    return rounded(charts.scatter_correlations(deaths(spark, sf_dir, *_AGE_COLUMNS), _AGE_COLUMNS))


@query()
def scatter_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5,000 plotted rows."""
    keyed = deaths(spark, sf_dir, *_AGE_COLUMNS, "l_orderkey", "l_linenumber")
    return charts.scatter_points(keyed, _AGE_COLUMNS, key=["l_orderkey", "l_linenumber"])


def _matrix_sql(cols: tuple[str, ...], source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 4) + 0.0 AS r FROM {source}"
        for a in cols
        for b in cols
    )


@query(_matrix_sql(MEASURES, "lineitem"))
def correlation_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(association.correlation_matrix(table(spark, sf_dir, "lineitem"), MEASURES))


@query(" UNION ALL ".join(_pairs_sql(MEASURES, "lineitem", 4)))
def correlation_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(association.ranked_correlations(table(spark, sf_dir, "lineitem"), MEASURES))


#: A component nearer to zero than this counts as missing, so that pairs of columns share different rows.
_SMALL = 0.01


@query(
    f"""WITH u AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS i FROM embeddings),
    p AS (SELECT vec_id, i, x FROM u WHERE abs(x) >= {_SMALL})
    SELECT 'e' || a.i AS a, 'e' || b.i AS b, count(*) AS n, round(corr(a.x, b.x), 4) + 0.0 AS r
    FROM p AS a JOIN p AS b USING (vec_id) GROUP BY 1, 2"""
)
def correlation_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every component of the vectors as a column with missing values, against every other."""
    vectors = table(spark, sf_dir, "embeddings")
    width = vectors.agg(F.max(F.size("embedding"))).first()[0] or 0
    x = [F.get("embedding", F.lit(i)).cast("double") for i in range(width)]
    columns = vectors.select(*[F.when(F.abs(c) >= _SMALL, c).alias(f"e{i}") for i, c in enumerate(x)])
    return rounded(gram.wide_correlations(columns, columns.columns))


@query(
    """WITH cells AS (SELECT p_name AS name, p_brand AS brand, count(*) AS n FROM part WHERE p_name IS NOT NULL AND p_brand IS NOT NULL GROUP BY 1, 2),
    m AS (SELECT *, sum(n) OVER (PARTITION BY name)::BIGINT AS row_total, sum(n) OVER (PARTITION BY brand)::BIGINT AS col_total, sum(n) OVER ()::DOUBLE AS total FROM cells)
    SELECT name, brand, n, row_total, col_total, round(n::DOUBLE / row_total * 100, 4) AS row_pct, round(row_total / total * col_total, 4) AS expected FROM m"""
)
def contingency_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the cells that occur, with margins, row percentages and expected counts."""
    parts = table(spark, sf_dir, "part").selectExpr("p_name AS name", "p_brand AS brand")
    return rounded(crosstab.contingency(parts, "name", "brand"))


#: The column categories that are asked for, one of which never occurs.
_LISTED = ("Brand#11", "Brand#22", "Brand#33", "Brand#00")


@query(
    f"""WITH cells AS (SELECT p_name AS name, p_brand AS brand, count(*) AS n FROM part WHERE p_name IS NOT NULL AND p_brand IS NOT NULL GROUP BY 1, 2)
    SELECT name, brand, coalesce(n, 0) AS n FROM (SELECT DISTINCT name FROM cells)
    CROSS JOIN (SELECT unnest({list(_LISTED)}) AS brand) LEFT JOIN cells USING (name, brand)"""
)
def crosstab_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts with zeros for the listed column categories."""
    parts = table(spark, sf_dir, "part").selectExpr("p_name AS name", "p_brand AS brand")
    return crosstab.listed_cells(parts, "name", "brand", _LISTED)


_GRID_SQL = f"""WITH {deaths_sql('areag', 'asist')}, cells AS (
      SELECT areag, asist, count(*) AS n FROM deaths
      WHERE areag IS NOT NULL AND asist IS NOT NULL GROUP BY 1, 2),
    grid AS (SELECT areag, asist, coalesce(n, 0) AS n FROM (SELECT DISTINCT areag FROM cells)
      CROSS JOIN (SELECT DISTINCT asist FROM cells) LEFT JOIN cells USING (areag, asist))"""


@query(f"{_GRID_SQL} SELECT * FROM grid")
def crosstab_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crosstab.crosstab_counts(deaths(spark, sf_dir, "areag", "asist"), "areag", "asist")


@query(
    """WITH cells AS (SELECT p_name AS name, p_brand AS brand, count(*) AS n FROM part GROUP BY 1, 2)
    SELECT name, brand, coalesce(n, 0) AS n FROM (SELECT DISTINCT name FROM cells)
    CROSS JOIN (SELECT DISTINCT brand FROM cells) LEFT JOIN cells USING (name, brand)"""
)
def crosstab_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table with many empty cells."""
    parts = table(spark, sf_dir, "part").selectExpr("p_name AS name", "p_brand AS brand")
    return crosstab.crosstab_counts(parts, "name", "brand")


@query(
    f"""{_GRID_SQL} SELECT areag, asist,
      round(CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY areag) * 100, 4) AS pct FROM grid"""
)
def crosstab_row_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(crosstab.crosstab_percent(deaths(spark, sf_dir, "areag", "asist"), "areag", "asist"))


_ASSISTANCE = ("Comadrona", "Empírica", "Médica", "Ninguna", "Paramédica")
_PIVOT_SQL = f"""WITH {deaths_sql('depocu', 'asist', 'caudef')}, wide AS (SELECT depocu, {
    ", ".join(f'''count(*) FILTER (asist = '{a}') AS "{a}"''' for a in _ASSISTANCE)
}, count(*) AS total FROM deaths WHERE caudef LIKE 'U07%' AND asist IS NOT NULL GROUP BY depocu)"""


@query(f"{_PIVOT_SQL} SELECT * EXCLUDE (total) FROM wide")
def pivot_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = hypotheses.cause_cells(deaths(spark, sf_dir, "depocu", "asist", "caudef", "_year"))
    return crosstab.pivot_sum(cells, "depocu", "asist", "n", _ASSISTANCE)


@query(
    f"""{_PIVOT_SQL} SELECT depocu, {
        ", ".join(f'round(CAST("{a}" AS DOUBLE) / total * 100, 4) AS "{a}"' for a in _ASSISTANCE)
    } FROM wide"""
)
def pivot_row_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    register = deaths(spark, sf_dir, "depocu", "asist", "caudef", "_year")
    return rounded(hypotheses.cause_percent(register, _ASSISTANCE))


@query(f"WITH {deaths_sql('_year')} SELECT _year, count(*) AS n FROM deaths GROUP BY 1")
def yearly_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_by(deaths(spark, sf_dir, "_year"), "_year").orderBy("_year")


@query(f"WITH {deaths_sql('mesocu')} SELECT mesocu, count(*) AS n FROM deaths GROUP BY 1")
def monthly_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frequency.distribution(deaths(spark, sf_dir, "mesocu"), "mesocu")


_INFANT = "perdif IN ('Menos De Un Mes', '1 A 11 Meses')"


@query(
    f"""WITH {deaths_sql('_year', 'depocu', 'perdif')}, cells AS (
      SELECT _year, depocu, count(*) AS n FROM deaths WHERE {_INFANT} GROUP BY 1, 2),
    top AS (SELECT depocu FROM cells GROUP BY 1 ORDER BY sum(n) DESC, depocu LIMIT 5)
    SELECT _year, depocu, n FROM cells
    WHERE depocu IN (SELECT depocu FROM top) OR depocu = 'Guatemala'"""
)
def top_departments_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hypotheses.infant_trend(deaths(spark, sf_dir, "_year", "depocu", "perdif"))


def _outlier_sql(cols: tuple[str, ...], source: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", round(q1, 4) AS q1, round(q3, 4) AS q3,
        round(q3 - q1, 4) AS iqr, round(q1 - 1.5 * (q3 - q1), 4) AS lower,
        round(q3 + 1.5 * (q3 - q1), 4) AS upper, count({c}) AS n,
        count(*) FILTER ({c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS n_outliers,
        round_even((count(*) FILTER ({c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1))
          / count({c}) * 100) * 100, 0) / 100 AS pct_outliers
        FROM {source}, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3
          FROM {source}) GROUP BY q1, q3 HAVING q3 <> q1"""
        for c in cols
    )


@query(
    f"""WITH e AS (SELECT value, CAST(event_id AS DOUBLE) AS id, 5.0 AS flat FROM events)
    {_outlier_sql(('value', 'id', 'flat'), 'e')}"""
)
def iqr_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A skewed, an even and a constant column; the constant one is left out."""
    events = table(spark, sf_dir, "events").selectExpr("value", "event_id AS id", "5.0D AS flat")
    return rounded(outliers.iqr_outliers(events, ("value", "id", "flat")))


@query("SELECT event_id, value FROM events WHERE value < 5 OR value > 60")
def outside_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.outside(table(spark, sf_dir, "events"), "value", 5, 60).select("event_id", "value")


@query(
    f"""WITH {deaths_sql('depocu', 'asist', 'caudef')} SELECT depocu, asist, count(*) AS n FROM deaths
    WHERE caudef LIKE 'U07%' AND asist IN ('Ninguna', 'Médica') AND depocu IS NOT NULL GROUP BY 1, 2"""
)
def prefix_filter_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix, membership and not-null filters under a two-key count."""
    register = deaths(spark, sf_dir, "depocu", "asist", "caudef")
    picked = register.where(
        F.col("caudef").startswith("U07") & F.col("asist").isin("Ninguna", "Médica")
    )
    return count_by(picked.dropna(subset=["depocu"]), "depocu", "asist")


@query(
    f"""WITH {deaths_sql('ocur', 'sexo')} SELECT sexo, count(*) AS n FROM deaths
    WHERE lower(ocur) LIKE '%pública%' GROUP BY 1"""
)
def substring_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    register = deaths(spark, sf_dir, "ocur", "sexo")
    return count_by(register.where(contains_ignore_case(F.col("ocur"), "Pública")), "sexo")


@query(
    f"""WITH {deaths_sql('areag')}, c AS (SELECT areag, count(*) AS n FROM deaths
      WHERE areag IS NOT NULL GROUP BY 1)
    SELECT areag, n, round(CAST(n AS DOUBLE) / (SELECT sum(n) FROM c) * 100, 4) AS pct FROM c"""
)
def group_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(frequency.group_share(deaths(spark, sf_dir, "areag"), "areag"))


@query(
    f"""WITH {deaths_sql('_year', 'perdif')}, i AS (SELECT _year, count(*) AS n FROM deaths
      WHERE {_INFANT} GROUP BY 1), s AS (SELECT CAST(sum(n) FILTER (_year = 2012) AS BIGINT) AS a,
      CAST(sum(n) FILTER (_year = 2018) AS BIGINT) AS b FROM i)
    SELECT a AS n_start, b AS n_end, round((b - a) * 100.0 / a, 4) AS pct_change FROM s"""
)
def relative_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    register = deaths(spark, sf_dir, "_year", "perdif").where(hypotheses.infant())
    return rounded(frequency.relative_change(count_by(register, "_year"), "_year", 2012, 2018))


@query(
    f"""WITH {deaths_sql('_year', 'edadif')}, t AS (SELECT _year, count(*) AS total FROM deaths
      GROUP BY 1), o AS (SELECT _year, count(*) AS old FROM deaths WHERE edadif > 49 AND _year > 2013
      GROUP BY 1) SELECT _year, total, coalesce(old, 0) AS old FROM t LEFT JOIN o USING (_year)"""
)
def merge_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Left join of two yearly aggregates; years without a match become 0."""
    register = deaths(spark, sf_dir, "_year", "edadif")
    total = count_by(register, "_year").withColumnRenamed("n", "total")
    old = count_by(register.where("edadif > 49 AND _year > 2013"), "_year")
    return frequency.merge_series(total, old.withColumnRenamed("n", "old"), "_year")


@query(
    """SELECT label, n FROM (SELECT label, count(*) AS n FROM embeddings GROUP BY 1)
    ORDER BY n DESC, label LIMIT 1"""
)
def arg_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label with the most rows, the smallest on ties."""
    sizes = count_by(table(spark, sf_dir, "embeddings"), "label")
    return counts.arg_max(sizes, "label", "n")


@query(
    "SELECT l_returnflag, least(100, count(*)) AS n FROM lineitem GROUP BY 1"
)
def sample_per_group_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber")
    picked = sample_per_group(keyed, "l_returnflag", ("A", "N", "R"), 100, key=["l_orderkey", "l_linenumber"])
    return count_by(picked, "l_returnflag")
