"""Raw vintages with drifting columns, derived from the generated tables.

Three generations of the death register come from orders: upper-case former names (to 2014),
a missing column and numeric codes (2015-2016), canonical names plus an extra column (from 2017).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from suite.facts import _case, table
from vitalframe.sources.landing import in_parallel
from vitalframe.sources.scratch import scratch_path

YEAR = "year(o_orderdate) + 17"
# Last years of the first two generations.
FIRST, SECOND = 2014, 2016

_SEX_OLD = {"F": " FEMENINO ", "O": "masculino", "P": "Ignorado"}
_SEX_NEW = {"F": "Mujer", "O": "Hombre", "P": "ignorado"}
_PEOPLE_OLD = {
    "MACHINERY": "mestizo / ladino",
    "FURNITURE": "XINCA",
    "BUILDING": "garífuna",
    "AUTOMOBILE": "indigena",
    "HOUSEHOLD": "No Indigena",
}
_PEOPLE_NEW = {
    "MACHINERY": "Mestizo, Ladino",
    "FURNITURE": "Xinka",
    "BUILDING": "Garifuna",
    "AUTOMOBILE": "MAYA",
    "HOUSEHOLD": "mestizo/ladino",
}
_CIVIL = {
    "1-URGENT": "casado(a)",
    "2-HIGH": " SOLTERO(A)",
    "3-MEDIUM": "viudo(a)",
    "4-NOT SPECIFIED": "Unido(a) ",
    "5-LOW": "no indicado",
}
_PERIOD = {"F": "1 año y má", "O": "menos de un mes", "P": "1 a 11 meses"}
_DEPARTMENT = "CASE n_name WHEN 'NATION_1' THEN 'QUICHE' WHEN 'NATION_2' THEN 'quiché' ELSE n_name END"
_COUNTRY = "CASE c_nationkey WHEN 0 THEN 320 WHEN 1 THEN 840 WHEN 2 THEN 1020 ELSE 77 END"
_AGE = "CASE WHEN o_orderkey % 10 = 0 THEN 999.0 ELSE CAST(o_orderkey % 90 AS DOUBLE) END"


def landed_years(spark: SparkSession, sf_dir: str) -> list[int]:
    """Years that orders have rows of."""
    years = table(spark, sf_dir, "orders").where("o_orderdate IS NOT NULL").selectExpr(f"{YEAR} AS y")
    return sorted(r["y"] for r in years.distinct().collect())


def generations(spark: SparkSession, sf_dir: str) -> dict[int, tuple[int, ...]]:
    """Landed years of each generation, by the generation's name."""
    found: dict[int, tuple[int, ...]] = {}
    for y in landed_years(spark, sf_dir):
        name = 2012 if y <= FIRST else 2015 if y <= SECOND else 2017
        found[name] = (*found.get(name, ()), y)
    return found


def _orders(spark: SparkSession, sf_dir: str, years: tuple[int, ...]) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    # A plain range on the date column, so that the filter reaches the Parquet scan.
    first, last = min(years) - 17, max(years) - 17
    inside = (F.col("o_orderdate") >= F.lit(f"{first}-01-01").cast("timestamp_ntz")) & (
        F.col("o_orderdate") < F.lit(f"{last + 1}-01-01").cast("timestamp_ntz")
    )
    return _people(orders.where(inside), customer, nation)


def _people(orders: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Orders with their customer and nation. Customers grow with the orders, so they are shuffled, never broadcast."""
    joined = orders.join(customer.hint("merge"), orders["o_custkey"] == customer["c_custkey"])
    return joined.join(nation, customer["c_nationkey"] == nation["n_nationkey"])


def raw_deaths(spark: SparkSession, sf_dir: str, years: tuple[int, ...], *extra: str) -> DataFrame:
    """Raw deaths of one generation, as they would land."""
    return _raw(_orders(spark, sf_dir, years), years, *extra)


def _raw(joined: DataFrame, years: tuple[int, ...], *extra: str) -> DataFrame:
    if years[0] <= FIRST:
        cols = [
            f"{_case('o_orderstatus', _SEX_OLD)} AS SEXO",
            f"{_case('c_mktsegment', _PEOPLE_OLD)} AS GETDIF",
            f"{_case('o_orderpriority', _CIVIL)} AS ECIDIF",
            f"{_DEPARTMENT} AS DEPOCU",
            f"{_AGE} AS EdadIf",
            f"{_case('o_orderstatus', _PERIOD)} AS PerDif",
            "'u071' AS CauDef",
            f"CAST({YEAR} AS DOUBLE) AS `AÑOOCU`",
            "'covid' AS `caudef.descrip`",
        ]
    elif years[0] <= SECOND:
        cols = [
            f"{_case('o_orderstatus', _SEX_NEW)} AS sexo",
            f"{_case('c_mktsegment', _PEOPLE_NEW)} AS puedif",
            f"{_case('o_orderpriority', _CIVIL)} AS ecidif",
            f"{_AGE} AS edadif",
            f"{_case('o_orderstatus', _PERIOD)} AS perdif",
            "'j189' AS caudef",
            f"CAST({_COUNTRY} AS DOUBLE) AS predif",
        ]
    else:
        cols = [
            f"{_case('o_orderstatus', _SEX_NEW)} AS sexo",
            f"{_case('c_mktsegment', _PEOPLE_NEW)} AS puedif",
            f"{_DEPARTMENT} AS depocu",
            f"{_AGE} AS edadif",
            f"{_case('o_orderstatus', _PERIOD)} AS perdif",
            "'i219' AS caudef",
            "o_orderpriority AS extra",
        ]
    return joined.selectExpr(*cols, *extra)


# Labels of the landed files: 999 marks an unknown age, births carry coded sex.
def file_labels(spark: SparkSession, sf_dir: str) -> dict:
    deaths = {
        f"{y}-deaths.parquet": {"edadif": {999: "Ignorado"}} for y in landed_years(spark, sf_dir)
    }
    return {**deaths, "births.parquet": {"sexo": {1: "Masculino", 2: "Femenino"}}}


_LANDED = ("o_orderkey", "o_orderdate", "o_orderstatus", "o_orderpriority", "c_mktsegment", "c_nationkey", "n_name")
_landed: dict[tuple[str, str], str] = {}


def landing_folder(spark: SparkSession, sf_dir: str) -> str:
    """Landing folder with one vintage per dataset and year; written once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key in _landed:
        return _landed[key]
    folder = scratch_path(spark, "landing")
    years = landed_years(spark, sf_dir)
    # One join for all years, and a folder for each, so that a year's vintage reads its own rows only.
    joined = scratch_path(spark, "landed")
    if years:
        people = _orders(spark, sf_dir, tuple(years)).select(*_LANDED, F.expr(f"{YEAR} AS landed_year"))
        people.write.partitionBy("landed_year").parquet(joined)

    def dated(y: int) -> DataFrame:
        return _raw(spark.read.parquet(joined).where(F.col("landed_year") == y), (y,))

    births = table(spark, sf_dir, "lineitem").selectExpr(
        "floor(l_quantity / 5) AS libras",
        "l_tax * 100 AS onzas",
        "CASE l_linestatus WHEN 'F' THEN 2.0D ELSE 1.0D END AS sexo",
        "l_returnflag AS tipar",
        "2019.0D AS anioreg",
    )
    marriages = table(spark, sf_dir, "customer").selectExpr(
        "c_mktsegment AS clauni", "20.0D + c_nationkey AS edadhom", "21.0D + c_nationkey AS edadmuj"
    )
    divorces = table(spark, sf_dir, "supplier").selectExpr(
        "30 + s_nationkey AS edadhom", "31 + s_nationkey AS edadmuj",
        "'docente' AS ocuhom", "'docente' AS ocumuj",
    )
    fetal = table(spark, sf_dir, "part").selectExpr(
        "p_size AS semges", "'p95x' AS caudef", "lower(p_type) AS tipar", "p_size + 10 AS edadm"
    )
    unknown = table(spark, sf_dir, "nation").selectExpr("n_name AS a", "n_regionkey AS b")
    writes = [
        lambda: births.write.parquet(f"{folder}/births.parquet"),
        *[lambda y=y: dated(y).write.parquet(f"{folder}/{y}-deaths.parquet") for y in years],
        *[lambda: dated(2012).write.parquet(f"{folder}/2012-deaths (1).parquet")] * (2012 in years),
        lambda: marriages.write.parquet(f"{folder}/2020-marriages.parquet"),
        lambda: divorces.write.option("header", True).csv(f"{folder}/2021-divorces.csv"),
        lambda: fetal.write.json(f"{folder}/2020-fetal.json"),
        lambda: unknown.write.parquet(f"{folder}/2021-unknown.parquet"),
        lambda: table(spark, sf_dir, "region").selectExpr("r_name").write.text(f"{folder}/2021-bad.parquet"),
    ]
    in_parallel(lambda write: write(), writes)
    _landed[key] = folder
    return folder


_OLD_CIVIL = {
    "1-URGENT": "Casado", "2-HIGH": "Soltero", "3-MEDIUM": "Viudo",
    "4-NOT SPECIFIED": "Unido", "5-LOW": "No Indicado",
}
_OLD_PEOPLE = {
    "MACHINERY": "Ladino/Mestizo", "FURNITURE": "Xinka", "BUILDING": "Garifuna",
    "AUTOMOBILE": "Indígena", "HOUSEHOLD": "No Indígena",
}
_NEW_PEOPLE = {
    "MACHINERY": "Ladino/Mestizo", "FURNITURE": "Xinka", "BUILDING": "Garifuna",
    "AUTOMOBILE": "Maya", "HOUSEHOLD": "Ladino/Mestizo",
}


def harmonised_sql(source_file: str, decoded: bool) -> str:
    """Expected harmonised deaths as a CTE, written from the meaning of each source column."""
    year = "(year(o_orderdate) + 17)"
    first, third = f"{year} <= 2014", f"{year} >= 2017"
    age = "CAST(o_orderkey % 90 AS DOUBLE)"
    unknown = "NULL" if decoded else "999.0"
    columns = {
        "depocu": f"CASE WHEN {first} OR {third} THEN CASE WHEN n_name IN ('NATION_1', 'NATION_2') "
        "THEN 'Quiché' ELSE 'Nation_' || c_nationkey END END",
        "areag": "CAST(NULL AS VARCHAR)",
        "sexo": _case("o_orderstatus", {"F": "Mujer", "O": "Hombre", "P": "Ignorado"}),
        "anioocu": f"CASE WHEN {first} THEN CAST({year} AS DOUBLE) END",
        "edadif": f"CASE WHEN o_orderkey % 10 = 0 THEN {unknown} ELSE {age} END",
        "perdif": _case("o_orderstatus", {"F": "1 Año Y Más", "O": "Menos De Un Mes", "P": "1 A 11 Meses"}),
        "puedif": f"CASE WHEN {first} THEN {_case('c_mktsegment', _OLD_PEOPLE)} "
        f"ELSE {_case('c_mktsegment', _NEW_PEOPLE)} END",
        "ecidif": f"CASE WHEN {third} THEN NULL ELSE {_case('o_orderpriority', _OLD_CIVIL)} END",
        "predif": f"CASE WHEN {first} OR {third} THEN NULL ELSE CASE c_nationkey "
        "WHEN 0 THEN 'Guatemala' WHEN 1 THEN 'Estados Unidos De América' "
        "WHEN 2 THEN 'Ignorado' ELSE '77.0' END END",
        "caudef": f"CASE WHEN {first} THEN 'U071' WHEN {third} THEN 'I219' ELSE 'J189' END",
        "_year": f"CAST({year} AS SMALLINT)",
        "_source_file": source_file,
    }
    from vitalframe.specs import canonical_schema

    kinds = {"string": "VARCHAR", "double": "DOUBLE"}
    picked = ", ".join(
        f"{columns[f.name]} AS {f.name}"
        if f.name in columns
        else f"CAST(NULL AS {kinds[f.dataType.simpleString()]}) AS {f.name}"
        for f in canonical_schema("defunciones")
    )
    return (
        f"harmonised AS (SELECT {picked} FROM orders JOIN customer ON o_custkey = c_custkey "
        "JOIN nation ON c_nationkey = n_nationkey)"
    )


DEATHS_FILE_SQL = "CAST(year(o_orderdate) + 17 AS VARCHAR) || '-deaths.parquet'"
