"""Registry-shaped tables over the generated star schema.

The microdata itself is not public here, so the queries run on a death register derived from
lineitem joined to its order, customer, nation and part. Each derived column is one SQL
expression, used both by Spark and by the SQL that checks the results. The source has no NULLs;
the ``CASE WHEN … % … THEN NULL`` expressions put some in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_MONTHS = (
    "Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio", "Julio",
    "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre",
)


def _case(column: str, pairs: dict, other: str = "NULL") -> str:
    def text(v):
        return str(v) if isinstance(v, int) else f"'{v}'"

    whens = " ".join(f"WHEN {text(k)} THEN {text(v)}" for k, v in pairs.items())
    return f"CASE {column} {whens} ELSE {other} END"


_ASSISTANCE = {
    "1-URGENT": "Médica",
    "2-HIGH": "Paramédica",
    "3-MEDIUM": "Comadrona",
    "4-NOT SPECIFIED": "Empírica",
    "5-LOW": "Ninguna",
}
_SCHOOLING = {
    "MACHINERY": "Ninguna",
    "FURNITURE": "Primaria",
    "BUILDING": "Básico",
    "AUTOMOBILE": "Diversificado",
    "HOUSEHOLD": "Universitario",
}
_CAUSES = {
    "ECONOMY": "U071",
    "PROMO": "U072",
    "SMALL": "J189",
    "MEDIUM": "I219",
    "LARGE": "E149",
    "STANDARD": "X599",
}
_PERIODS = {"A": "Menos De Un Mes", "R": "1 A 11 Meses", "N": "1 Año Y Más"}

# column -> (tables beyond lineitem it needs, expression)
DEATH_COLUMNS: dict[str, tuple[tuple[str, ...], str]] = {
    "_year": (("orders",), "CAST(year(o_orderdate) + 17 AS INT)"),
    "mesocu": (
        ("orders",),
        _case("month(o_orderdate)", {i: m for i, m in enumerate(_MONTHS, start=1)}),
    ),
    "diaocu": (("orders",), "CAST(day(o_orderdate) AS DOUBLE)"),
    "anioocu": (("orders",), "CAST(year(o_orderdate) + 17 AS DOUBLE)"),
    "depocu": (("orders", "customer", "nation"), _case("n_name", {"NATION_0": "Guatemala"}, "n_name")),
    "asist": (
        ("orders",),
        f"CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE {_case('o_orderpriority', _ASSISTANCE)} END",
    ),
    "areag": (
        ("orders",),
        "CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE "
        + _case("o_orderstatus", {"F": "Rural", "O": "Urbano", "P": "Ignorado"})
        + " END",
    ),
    "sexo": ((), _case("l_linestatus", {"F": "Mujer", "O": "Hombre"})),
    "edadif": (
        (),
        "CASE WHEN l_linenumber = 7 AND l_orderkey % 3 = 0 THEN NULL ELSE l_quantity END",
    ),
    "perdif": ((), _case("l_returnflag", _PERIODS)),
    "escodif": (("orders", "customer"), _case("c_mktsegment", _SCHOOLING)),
    "caudef": (("part",), _case("p_type", _CAUSES)),
    "ocur": (
        ("part",),
        "CASE WHEN p_name LIKE 'hot%' THEN 'Vía Pública' WHEN p_name LIKE 'red%' THEN 'VÍA PÚBLICA' "
        "WHEN p_name LIKE 'cold%' THEN 'Hospital Público' WHEN p_name LIKE 'old%' THEN NULL "
        "ELSE 'Domicilio' END",
    ),
    "l_orderkey": ((), "l_orderkey"),
    "l_linenumber": ((), "l_linenumber"),
    "libras": ((), "l_extendedprice"),
    "onzas": ((), "l_discount"),
    "semges": ((), "l_tax"),
}

ALL_DEATH_COLUMNS = [c for c in DEATH_COLUMNS if not c.startswith("l_")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def deaths(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    """Death register with the named columns; joins only the tables those columns need."""
    needed = {t for c in cols for t in DEATH_COLUMNS[c][0]}
    df = table(spark, sf_dir, "lineitem")
    if "orders" in needed:
        orders = table(spark, sf_dir, "orders")
        df = df.join(orders, df["l_orderkey"] == orders["o_orderkey"])
    if "customer" in needed:
        customer = table(spark, sf_dir, "customer")
        df = df.join(customer, df["o_custkey"] == customer["c_custkey"])
    if "nation" in needed:
        nation = table(spark, sf_dir, "nation")
        df = df.join(nation, df["c_nationkey"] == nation["n_nationkey"])
    if "part" in needed:
        part = table(spark, sf_dir, "part")
        df = df.join(part, df["l_partkey"] == part["p_partkey"])
    return df.selectExpr(*[f"{DEATH_COLUMNS[c][1]} AS {c}" for c in cols])


_JOINED = """
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    JOIN part ON l_partkey = p_partkey
"""


def deaths_sql(*cols: str) -> str:
    """The same register as a CTE named ``deaths``, for SQL checks."""
    picked = ", ".join(f"{DEATH_COLUMNS[c][1]} AS {c}" for c in cols)
    return f"deaths AS (SELECT {picked} {_JOINED})"
