"""Registered queries: the query interface, profiles and descriptive statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from suite.facts import ALL_DEATH_COLUMNS, deaths, deaths_sql, table
from suite.q_ingest import _harmonised, load_once
from suite.registry import query, rounded
from vitalframe import specs
from vitalframe.functions.text import contains_ignore_case, literal_map, strip, title_case
from vitalframe.operators import counts, profile, sampling
from vitalframe.plans import api, overview

MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(
    """SELECT l_orderkey, l_quantity, l_shipdate FROM lineitem
    WHERE l_quantity BETWEEN 15 AND 40 AND l_returnflag = 'R'"""
)
def load_projection_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return api.select_rows(
        table(spark, sf_dir, "lineitem"),
        columns=["l_orderkey", "l_quantity", "l_shipdate"],
        where="l_quantity BETWEEN 15 AND 40 AND l_returnflag = 'R'",
    )


@query()
def load_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """1,000 rows by hashed key, the same on every run."""
    return api.select_rows(
        table(spark, sf_dir, "lineitem"), sample_n=1_000, key=["l_orderkey", "l_linenumber"]
    )


@query("SELECT least(1000, count(*)) AS n, least(1000, count(*)) AS n_distinct FROM lineitem")
def sample_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of a keyed sample and its distinct rows: without replacement."""
    keyed = table(spark, sf_dir, "orders").select("o_orderkey")
    picked = sampling.sample_rows(keyed, 1_000, key=["o_orderkey"])
    return picked.agg(
        F.count("*").alias("n"), F.count_distinct("o_orderkey").alias("n_distinct")
    )


@query("SELECT CAST(year(o_orderdate) + 17 AS SMALLINT) AS _year, count(*) AS n FROM orders GROUP BY 1")
def yearly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, _ = load_once(spark, sf_dir)
    return api.Registry(spark, root).yearly_counts("defunciones")


_TABLE_COUNTS = """SELECT 'defunciones' AS dataset, count(*) AS n FROM orders
    UNION ALL SELECT 'nacimientos', count(*) FROM lineitem
    UNION ALL SELECT 'matrimonios', count(*) FROM customer
    UNION ALL SELECT 'divorcios', count(*) FROM supplier
    UNION ALL SELECT 'defunciones_fetales', count(*) FROM part"""


@query(f"SELECT dataset, CAST(sum(n) AS BIGINT) AS n FROM ({_TABLE_COUNTS}) GROUP BY ROLLUP (dataset)")
def table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, _ = load_once(spark, sf_dir)
    return api.Registry(spark, root).table_counts()


@query(f"SELECT dataset FROM ({_TABLE_COUNTS}) WHERE n > 0")
def list_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, _ = load_once(spark, sf_dir)
    names = [(d,) for d in api.Registry(spark, root).list_datasets()]
    return spark.createDataFrame(names, "dataset string")


@query("SELECT DISTINCT CAST(year(o_orderdate) + 17 AS SMALLINT) AS _year FROM orders")
def distinct_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, _ = load_once(spark, sf_dir)
    return api.Registry(spark, root).distinct_years("defunciones")


@query(
    """SELECT CAST(year(o_orderdate) + 17 AS SMALLINT) AS _year,
      CASE o_orderstatus WHEN 'F' THEN 'Mujer' WHEN 'O' THEN 'Hombre' ELSE 'Ignorado' END AS sexo,
      count(*) AS n FROM orders GROUP BY ALL"""
)
def register_and_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Free SQL over the registered views."""
    root, _ = load_once(spark, sf_dir)
    return api.Registry(spark, root).sql(
        "SELECT _year, sexo, count(*) AS n FROM defunciones GROUP BY 1, 2"
    )


def _summary_sql(columns: dict[str, str], source: str) -> str:
    parts = []
    for c, kind in columns.items():
        number = kind != "string"
        avg = f"round(avg({c}), 4)" if number else "CAST(NULL AS DOUBLE)"
        std = f"round(stddev_samp({c}), 4)" if number else "CAST(NULL AS DOUBLE)"
        parts.append(
            f"""SELECT '{c}' AS column_name, '{kind}' AS column_type, CAST(min({c}) AS VARCHAR) AS min,
            CAST(max({c}) AS VARCHAR) AS max, {avg} AS avg, {std} AS std, count(*) AS count,
            round_even((count(*) FILTER ({c} IS NULL) / count(*) * 100) * 100, 0) / 100 AS null_percentage
            FROM {source}"""
        )
    return " UNION ALL ".join(parts)


_SUMMARY_COLUMNS = {
    "_year": "int", "mesocu": "string", "diaocu": "double", "depocu": "string",
    "asist": "string", "areag": "string", "sexo": "string", "edadif": "double",
    "escodif": "string", "perdif": "string", "caudef": "string", "ocur": "string",
}


@query(f"WITH {deaths_sql(*_SUMMARY_COLUMNS)} {_summary_sql(_SUMMARY_COLUMNS, 'deaths')}")
def summarize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column summary without the sketched columns."""
    rows = profile.summarize(deaths(spark, sf_dir, *_SUMMARY_COLUMNS))
    return rounded(rows.drop("approx_unique", "q25", "q50", "q75"))


@query()
def summarize_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Approximate distinct counts and quartiles of the column summary."""
    rows = profile.summarize(deaths(spark, sf_dir, *_SUMMARY_COLUMNS))
    return rows.select("column_name", "approx_unique", "q25", "q50", "q75")


@query("SELECT CAST(count(*) AS BIGINT) AS n FROM (SELECT DISTINCT year(o_orderdate) FROM orders)")
def arrow_handoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A yearly aggregate handed over as an Arrow table and as pandas; both have a row per year."""
    orders = table(spark, sf_dir, "orders").selectExpr("CAST(year(o_orderdate) AS INT) AS _year")
    yearly = api.yearly_counts(orders)
    arrow, frame = api.Registry.to_arrow(yearly), api.Registry.to_pandas(yearly)
    if arrow.num_rows != len(frame):
        raise AssertionError("Arrow and pandas hand-offs differ")
    return spark.createDataFrame(arrow).agg(F.count("*").alias("n"))


def _profile_sql(columns: list[str], kinds: dict[str, str], labels: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT {i} AS position, '{c}' AS "column", '{labels.get(c, c)}' AS description,
        '{kinds[c]}' AS type, count(DISTINCT {c}) AS n_unique, count(*) FILTER ({c} IS NULL) AS n_null,
        round_even((count(*) FILTER ({c} IS NULL) / count(*) * 100) * 10, 0) / 10 AS pct_null, count(*) AS n_rows
        FROM deaths"""
        for i, c in enumerate(columns)
    )


_PROFILED = [c for c in ALL_DEATH_COLUMNS if c != "_year"]
_KINDS = {
    c: "double" if c in ("diaocu", "anioocu", "edadif", "libras", "onzas", "semges") else "string"
    for c in _PROFILED
}
_PROFILE_SQL = f"""WITH {deaths_sql(*_PROFILED)}, profile AS (
    {_profile_sql(_PROFILED, _KINDS, specs.column_descriptions('defunciones'))})"""


def _death_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.variable_profile(
        deaths(spark, sf_dir, *_PROFILED), descriptions=specs.column_descriptions("defunciones")
    )


@query(f"{_PROFILE_SQL} SELECT * FROM profile")
def variable_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _death_profile(spark, sf_dir)


@query()
def variable_profile_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shuffle-free variant with sketched distinct counts."""
    return profile.variable_profile(deaths(spark, sf_dir, *_PROFILED), approx=True)


@query(
    f"""{_PROFILE_SQL} SELECT "column", CASE
      WHEN type = 'double' AND n_rows - n_null > n_rows * 0.7 THEN 'cluster numeric'
      WHEN type = 'string' AND n_unique BETWEEN 2 AND 10 AND n_rows - n_null > n_rows * 0.5
        THEN 'crosstab'
      WHEN type = 'string' AND n_unique <= 50 AND n_rows - n_null > n_rows * 0.1 THEN 'frequency'
      END AS role FROM profile"""
)
def column_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roles of columns by cardinality and coverage."""
    found = _death_profile(spark, sf_dir)
    rules = (
        ("cluster numeric", profile.select_columns(found, "numeric", min_cover=0.7)),
        ("crosstab", profile.select_columns(found, "categorical", 2, 10, 0.5)),
        ("frequency", profile.select_columns(found, "categorical", 0, 50, 0.1)),
    )
    roles = None
    for order, (role, rows) in enumerate(rules):
        part = rows.select("column", F.struct(F.lit(order), F.lit(role).alias("role")).alias("r"))
        roles = part if roles is None else roles.union(part)
    first = roles.groupBy("column").agg(F.min("r").alias("r"))
    return found.join(first, "column", "left").select("column", F.col("r.role").alias("role"))


@query(
    f"""WITH {deaths_sql(*_PROFILED)} SELECT * FROM (
    {" UNION ALL ".join(f'''SELECT '{c}' AS "column", count(*) FILTER ({c} IS NULL) AS n_null,
      round_even((count(*) FILTER ({c} IS NULL) / count(*) * 100) * 10, 0) / 10 AS pct_null FROM deaths'''
      for c in _PROFILED)}) WHERE pct_null > 5"""
)
def missingness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns with more than five percent NULL."""
    return profile.missingness(deaths(spark, sf_dir, *_PROFILED), 5.0)


@query(
    f"""WITH {deaths_sql('anioocu', 'diaocu', 'edadif')} SELECT 'anioocu' AS "column",
      avg(CASE WHEN anioocu BETWEEN 2000 AND 2030 THEN 1.0 ELSE 0 END) AS year_share,
      true AS is_identifier FROM deaths
    UNION ALL SELECT 'diaocu', 0.0, false UNION ALL SELECT 'edadif', 0.0, false"""
)
def identifier_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.identifier_like(deaths(spark, sf_dir, "anioocu", "diaocu", "edadif"))


def _describe_sql(cols: tuple[str, ...], source: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS n, round(avg({c}), 4) AS mean,
        round(stddev_samp({c}), 4) AS std, round(min({c}), 4) AS min,
        round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.5), 4) AS q50,
        round(quantile_cont({c}, 0.75), 4) AS q75, round(max({c}), 4) AS max FROM {source}"""
        for c in cols
    )


@query(f"WITH {deaths_sql('edadif', 'diaocu', 'libras')} {_describe_sql(('edadif', 'diaocu', 'libras'), 'deaths')}")
def numeric_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = ("edadif", "diaocu", "libras")
    return rounded(profile.numeric_describe(deaths(spark, sf_dir, *cols), cols))


@query()
def numeric_describe_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quartiles from sketches, in one pass without a shuffle of values."""
    cols = ("edadif", "diaocu", "libras")
    return rounded(profile.numeric_describe(deaths(spark, sf_dir, *cols), cols, approx=True))


@query(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", round(quantile_cont({c}, 0.5), 4) AS median,
        (SELECT round({c}, 4) FROM lineitem GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS mode,
        round(skewness({c}), 4) AS skew, round(kurtosis({c}), 4) AS kurtosis,
        round_even((stddev_samp({c}) / avg({c}) * 100) * 100, 0) / 100 AS cv_pct,
        round(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25), 4) AS iqr FROM lineitem"""
        for c in MEASURES
    )
)
def numeric_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.numeric_shape(table(spark, sf_dir, "lineitem"), MEASURES))


_TENTHS = {f"p{i}0": i / 10 for i in range(1, 10)}


@query(
    "SELECT 'l_extendedprice' AS \"column\", l_returnflag, "
    + ", ".join(f"round(quantile_cont(l_extendedprice, {p}), 4) AS {n}" for n, p in _TENTHS.items())
    + " FROM lineitem GROUP BY l_returnflag"
)
def exact_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deciles of a continuous column by group."""
    lines = table(spark, sf_dir, "lineitem")
    return rounded(counts.exact_quantiles(lines, ["l_extendedprice"], _TENTHS, ["l_returnflag"]))


@query(
    """SELECT l_returnflag, round(avg(l_quantity), 4) AS l_quantity, round(avg(l_tax), 4) AS l_tax
    FROM lineitem GROUP BY 1"""
)
def group_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(counts.mean_by(table(spark, sf_dir, "lineitem"), "l_returnflag", ["l_quantity", "l_tax"]))


@query(
    f"""WITH {deaths_sql('escodif', 'edadif')} SELECT escodif, count(edadif) AS n,
      quantile_cont(edadif, 0.5) AS median FROM deaths WHERE escodif IS NOT NULL GROUP BY 1"""
)
def group_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.medians(deaths(spark, sf_dir, "escodif", "edadif"), "edadif", "escodif")


@query(
    f"""WITH {deaths_sql('depocu', 'asist', 'sexo')}, a AS (
      SELECT depocu, asist, row_number() OVER (PARTITION BY depocu ORDER BY count(*) DESC, asist) AS r
      FROM deaths WHERE asist IS NOT NULL GROUP BY 1, 2), s AS (
      SELECT depocu, sexo, row_number() OVER (PARTITION BY depocu ORDER BY count(*) DESC, sexo) AS r
      FROM deaths WHERE sexo IS NOT NULL GROUP BY 1, 2)
    SELECT depocu, a.asist, s.sexo FROM a JOIN s USING (depocu) WHERE a.r = 1 AND s.r = 1"""
)
def group_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.mode_by(deaths(spark, sf_dir, "depocu", "asist", "sexo"), "depocu", ["asist", "sexo"])


@query("SELECT count(*) AS n FROM lineitem")
def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.row_count(table(spark, sf_dir, "lineitem"))


@query(
    f"""WITH {deaths_sql('_year', 'depocu', 'perdif')}, cells AS (
      SELECT _year, depocu, perdif, count(*) AS n FROM deaths GROUP BY ALL)
    SELECT _year, CAST(sum(n) AS BIGINT) AS n FROM cells GROUP BY 1"""
)
def reaggregate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by three keys, summed up to one."""
    cells = counts.count_by(deaths(spark, sf_dir, "_year", "depocu", "perdif"), "_year", "depocu", "perdif")
    return counts.sum_counts(cells, "_year")


@query(
    """SELECT 'defunciones' AS dataset, count(*) AS n_rows, 28 AS n_fields,
      'depreg, mupreg, mesreg, anioreg, depocu, mupocu, areag, sexo, diaocu, mesocu, anioocu, edadif, perdif, puedif, ecidif' AS first_fields,
      count(DISTINCT year(o_orderdate)) AS n_years, CAST(min(year(o_orderdate)) + 17 AS INT) AS first_year,
      CAST(max(year(o_orderdate)) + 17 AS INT) AS last_year FROM orders
    UNION ALL SELECT 'matrimonios', count(*), 23,
      'depreg, mupreg, mesreg, anioreg, anioocu, clauni, nunuho, nunumu, edadhom, edadmuj, puehom, puemuj, nachom, nacmuj, eschom',
      1, 2020, 2020 FROM customer"""
)
def dataset_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, _ = load_once(spark, sf_dir)
    registry = api.Registry(spark, root)
    return overview.dataset_overview({d: registry.table(d) for d in ("defunciones", "matrimonios")})


@query(
    """SELECT 'defunciones' AS dataset, count(*) AS n_rows, 28 AS n_fields,
      'depreg, mupreg, mesreg, anioreg, depocu, mupocu, areag, sexo, diaocu, mesocu, anioocu, edadif, perdif, puedif, ecidif' AS first_fields,
      count(DISTINCT year(o_orderdate)) AS n_years, CAST(min(year(o_orderdate)) + 17 AS INT) AS first_year,
      CAST(max(year(o_orderdate)) + 17 AS INT) AS last_year FROM orders
    UNION ALL SELECT 'nacimientos', count(*), 44,
      'depreg, mupreg, mesreg, anioreg, tipoins, depocu, mupocu, libras, onzas, diaocu, mesocu, anioocu, sexo, tipar, viapar',
      1, 2019, 2019 FROM lineitem
    UNION ALL SELECT 'matrimonios', count(*), 23,
      'depreg, mupreg, mesreg, anioreg, anioocu, clauni, nunuho, nunumu, edadhom, edadmuj, puehom, puemuj, nachom, nacmuj, eschom',
      1, 2020, 2020 FROM customer
    UNION ALL SELECT 'divorcios', count(*), 19,
      'depreg, mupreg, mesreg, anioreg, diaocu, mesocu, anioocu, depocu, mupocu, edadhom, edadmuj, puehom, puemuj, nachom, nacmuj',
      1, 2021, 2021 FROM supplier
    UNION ALL SELECT 'defunciones_fetales', count(*), 31,
      'depreg, mupreg, mesreg, anioreg, depocu, mupocu, areag, sexo, diaocu, mesocu, anioocu, tipar, clapar, viapar, semges',
      1, 2020, 2020 FROM part"""
)
def dataset_overview_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The overview of all five datasets."""
    root, _ = load_once(spark, sf_dir)
    registry = api.Registry(spark, root)
    return overview.dataset_overview({d: registry.table(d) for d in specs.datasets()})


@query(
    """SELECT count(*) FILTER (l_returnflag = 'R') AS n_loaded, count(*) AS n_stored,
      round_even((count(*) FILTER (l_returnflag = 'R') / count(*) * 100) * 10, 0) / 10 AS pct FROM lineitem"""
)
def loaded_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return overview.loaded_share(lines.where("l_returnflag = 'R'"), lines)


@query(
    f"""WITH {_PROFILE_SQL.removeprefix('WITH ')} SELECT "column", description FROM profile
    WHERE n_null > 0"""
)
def column_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Descriptions of the columns that have NULLs, from the metadata table."""
    found = profile.variable_profile(deaths(spark, sf_dir, *_PROFILED)).where("n_null > 0")
    labels = specs.description_frame(spark, "defunciones")
    return found.select("column").join(labels, "column")


@query(
    r"""SELECT o_orderkey, lower(o_orderpriority) AS lowered,
      trim('  ' || o_orderpriority || ' ') AS trimmed,
      regexp_replace(lower(o_orderpriority), '[^a-z0-9]+', '_', 'g') AS replaced,
      regexp_extract(o_orderpriority, '^(\d)', 1) AS captured,
      contains(lower(o_orderpriority), 'medium') AS found, starts_with(o_orderpriority, '5') AS prefixed,
      split_part(o_orderpriority, '-', 1) AS first_part, left(o_orderpriority, 4) || '...' AS cut,
      CAST(o_totalprice AS VARCHAR) AS as_text, CAST(year(o_orderdate) AS SMALLINT) AS as_short,
      TRY_CAST(o_orderpriority AS DOUBLE) AS not_number, abs(o_totalprice - 100000) AS magnitude,
      round(sqrt(o_totalprice), 4) AS root, round(o_totalprice / 7, 2) AS ratio,
      CASE WHEN o_orderstatus = 'F' THEN 'rural' ELSE 'other' END AS bucket,
      coalesce(CASE o_orderstatus WHEN 'O' THEN 'open' END, o_orderstatus) AS looked_up,
      o_orderstatus IN ('F', 'P') AS member, format('{:,.2f}', o_totalprice) AS shown
    FROM orders"""
)
def scalar_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, price, status = F.col("o_orderpriority"), F.col("o_totalprice"), F.col("o_orderstatus")
    known = literal_map({"O": "open"})
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.lower(p).alias("lowered"),
        strip(F.concat(F.lit("  "), p, F.lit(" "))).alias("trimmed"),
        F.regexp_replace(F.lower(p), "[^a-z0-9]+", "_").alias("replaced"),
        F.regexp_extract(p, r"^(\d)", 1).alias("captured"),
        contains_ignore_case(p, "Medium").alias("found"),
        p.startswith("5").alias("prefixed"),
        F.substring_index(p, "-", 1).alias("first_part"),
        F.concat(F.left(p, F.lit(4)), F.lit("...")).alias("cut"),
        price.cast("string").alias("as_text"),
        F.year("o_orderdate").cast("short").alias("as_short"),
        p.try_cast("double").alias("not_number"),
        F.abs(price - 100000).alias("magnitude"),
        F.round(F.sqrt(price), 4).alias("root"),
        F.round(price / 7, 2).alias("ratio"),
        F.when(status == "F", "rural").otherwise("other").alias("bucket"),
        F.coalesce(F.try_element_at(known, status), status).alias("looked_up"),
        F.array_contains(F.array(F.lit("F"), F.lit("P")), status).alias("member"),
        F.format_number(price, 2).alias("shown"),
    )


@query(
    """SELECT o_orderstatus, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY 1"""
)
def json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows turned into JSON texts and queried by field."""
    from vitalframe.sources.documents import to_documents

    written = to_documents(table(spark, sf_dir, "orders"), "orders")
    status = F.get_json_object("value", "$.o_orderstatus").alias("o_orderstatus")
    return counts.count_by(written.select(status), "o_orderstatus")


@query(
    """SELECT puedif, count(*) AS n FROM (
      SELECT CASE c_mktsegment WHEN 'MACHINERY' THEN 'Machinery' WHEN 'FURNITURE' THEN 'Furniture'
        WHEN 'BUILDING' THEN 'Building' WHEN 'AUTOMOBILE' THEN 'Automobile' ELSE 'Household' END
        || '(' || upper(left(c_mktsegment, 1)) || lower(substr(c_mktsegment, 2)) || ')/1er Año' AS puedif
      FROM customer) GROUP BY 1"""
)
def title_case_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that start after brackets, slashes and digits."""
    raw = table(spark, sf_dir, "customer").selectExpr(
        "c_mktsegment || '(' || lower(c_mktsegment) || ')/1ER AÑO' AS t"
    )
    return counts.count_by(raw.select(title_case(F.col("t")).alias("puedif")), "puedif")


@query("SELECT CAST(year(o_orderdate) + 17 AS SMALLINT) AS _year, count(*) AS n FROM orders GROUP BY 1")
def overview_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    years, _ = overview.temporal_overview(_harmonised(spark, sf_dir), "mesocu")
    return years


@query(
    f"""WITH {deaths_sql('_year', 'mesocu')} SELECT 'year' AS period, CAST(_year AS VARCHAR) AS value,
      count(*) AS n FROM deaths GROUP BY ALL
    UNION ALL SELECT 'month', mesocu, count(*) FROM deaths WHERE mesocu IS NOT NULL GROUP BY ALL"""
)
def overview_by_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both halves of the overview in time as one long table: years, then months."""
    years, months = overview.temporal_overview(deaths(spark, sf_dir, "_year", "mesocu"), "mesocu")
    parts = [
        half.select(F.lit(period).alias("period"), F.col(c).cast("string").alias("value"), "n")
        for period, half, c in (("year", years, "_year"), ("month", months, "mesocu"))
    ]
    return parts[0].union(parts[1])
