"""Registered queries: landing, decoding, harmonising and storing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from suite.facts import table
from suite.landing_data import (
    DEATHS_FILE_SQL,
    file_labels,
    generations,
    harmonised_sql,
    landing_folder,
    raw_deaths,
)
from suite.registry import query, rounded
from vitalframe import specs
from vitalframe.functions import text
from vitalframe.operators import decode
from vitalframe.operators.counts import count_by
from vitalframe.operators.harmonize import harmonize, union_vintages
from vitalframe.plans import etl
from vitalframe.plans.api import yearly_counts
from vitalframe.sources import curated, documents, landing
from vitalframe.sources.scratch import scratch_path
from vitalframe.streaming.landing_stream import stream_landing

_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@query(
    " UNION ALL ".join(
        f"SELECT '{t}.parquet' AS filename, 'desconocido' AS dataset_type, count(*) AS nrows, "
        f"(SELECT CAST(count(*) AS INT) FROM information_schema.columns WHERE table_name = '{t}') "
        f"AS ncols FROM {t}"
        for t in _TABLES
    )
)
def landing_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inventory of the given folder itself: every file, its rows and columns."""
    return landing.scan(spark, sf_dir).select("filename", "dataset_type", "nrows", "ncols")


_DEATHS_PER_YEAR = "SELECT year(o_orderdate) + 17 AS y, count(*) AS n FROM orders GROUP BY 1"
_INVENTORY_SQL = f"""
    WITH per_year AS ({_DEATHS_PER_YEAR}), inventory AS (
      SELECT CAST(y AS VARCHAR) || '-deaths.parquet' AS filename, 'defunciones' AS dataset_type,
        CAST(y AS INT) AS year, n AS nrows,
        CASE WHEN y <= 2014 THEN 9 ELSE 7 END AS ncols, false AS is_duplicate, false AS failed
      FROM per_year
      UNION ALL SELECT '2012-deaths (1).parquet', 'defunciones', 2012, n, 9, true, false
      FROM per_year WHERE y = 2012
      UNION ALL SELECT 'births.parquet', 'nacimientos', 2019, count(*), 5, false, false FROM lineitem
      UNION ALL SELECT '2020-marriages.parquet', 'matrimonios', 2020, count(*), 3, false, false
      FROM customer
      UNION ALL SELECT '2021-divorces.csv', 'divorcios', 2021, count(*), 4, false, false FROM supplier
      UNION ALL SELECT '2020-fetal.json', 'defunciones_fetales', 2020, count(*), 4, false, false
      FROM part
      UNION ALL SELECT '2021-unknown.parquet', 'desconocido', 2021, count(*), 2, false, false
      FROM nation
      UNION ALL SELECT '2021-bad.parquet', 'error', NULL, 0, 0, false, true
    )"""


@query(f"{_INVENTORY_SQL} SELECT * FROM inventory")
def landing_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    inventory = landing.scan(spark, landing_folder(spark, sf_dir))
    return inventory.select(
        "filename", "dataset_type", "year", "nrows", "ncols", "is_duplicate",
        F.col("error").isNotNull().alias("failed"),
    )


@query(f"{_INVENTORY_SQL} SELECT filename, dataset_type FROM inventory WHERE NOT failed")
def classify_by_signature(spark: SparkSession, sf_dir: str) -> DataFrame:
    inventory = landing.scan(spark, landing_folder(spark, sf_dir)).where("error IS NULL")
    return inventory.select("filename", landing.classify(F.col("columns")).alias("dataset_type"))


@query(
    f"""{_INVENTORY_SQL} SELECT dataset_type, count(*) AS n_files,
      coalesce(string_agg(CAST(year AS VARCHAR), ',' ORDER BY year), '') AS years,
      min(year) AS first_year, max(year) AS last_year, CAST(sum(nrows) AS BIGINT) AS total_rows
    FROM inventory WHERE NOT is_duplicate GROUP BY dataset_type"""
)
def scan_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = landing.scan_summary(landing.scan(spark, landing_folder(spark, sf_dir)))
    return summary.withColumn("years", F.array_join("years", ","))


@query(
    f"""{_INVENTORY_SQL} SELECT filename, CASE WHEN is_duplicate THEN 'copy'
      WHEN dataset_type = 'desconocido' THEN 'unknown columns' ELSE 'unreadable' END AS reason
    FROM inventory WHERE is_duplicate OR dataset_type IN ('desconocido', 'error')"""
)
def quarantine_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = landing.quarantined_files(landing.scan(spark, landing_folder(spark, sf_dir)))
    plain = F.when(F.col("reason").isin("copy", "unknown columns"), F.col("reason"))
    return held.select("filename", F.coalesce(plain, F.lit("unreadable")).alias("reason"))


@query(
    f"""{_INVENTORY_SQL} SELECT filename, dataset_type, year FROM inventory
    WHERE NOT is_duplicate AND dataset_type NOT IN ('desconocido', 'error')"""
)
def drop_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = landing.loadable_files(landing.scan(spark, landing_folder(spark, sf_dir)))
    return files.select("filename", "dataset_type", "year")


_NAMES = """CASE CAST(o_orderkey % 4 AS INT)
    WHEN 0 THEN concat(CAST(year(o_orderdate) + 17 AS STRING), '-deaths.parquet')
    WHEN 1 THEN concat(CAST(year(o_orderdate) AS STRING), '-deaths.parquet')
    WHEN 2 THEN concat('x', CAST(year(o_orderdate) + 17 AS STRING), '.parquet')
    ELSE concat(CAST(year(o_orderdate) + 30 AS STRING), '99-deaths (1).parquet') END"""


@query(
    f"""WITH names AS (SELECT o_orderkey, {_NAMES} AS name FROM orders),
    years AS (SELECT *, TRY_CAST(regexp_extract(name, '^(\\d{{4}})', 1) AS INT) AS y FROM names)
    SELECT o_orderkey, CASE WHEN y BETWEEN 2009 AND 2030 THEN y END AS year,
      contains(name, '(1)') AS is_duplicate FROM years"""
)
def year_from_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = table(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{_NAMES} AS name")
    return named.select(
        "o_orderkey",
        text.year_from_name(F.col("name"), *specs.YEAR_RANGE).alias("year"),
        landing.is_copy(F.col("name")).alias("is_duplicate"),
    )


_loaded: dict[tuple[str, str], tuple[str, etl.LoadResult]] = {}


def load_once(spark: SparkSession, sf_dir: str) -> tuple[str, etl.LoadResult]:
    """Curated root and load result; the load runs once per session and folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _loaded:
        root = scratch_path(spark, "curated")
        loaded = etl.run_load(spark, landing_folder(spark, sf_dir), root, labels=file_labels(spark, sf_dir))
        _loaded[key] = (root, loaded)
    return _loaded[key]


_LOAD_REPORT_SQL = """WITH counts AS (
      SELECT 'defunciones' AS dataset, count(DISTINCT year(o_orderdate)) AS n_files, count(*) AS n_rows
      FROM orders
      UNION ALL SELECT 'nacimientos', 1, count(*) FROM lineitem
      UNION ALL SELECT 'matrimonios', 1, count(*) FROM customer
      UNION ALL SELECT 'divorcios', 1, count(*) FROM supplier
      UNION ALL SELECT 'defunciones_fetales', 1, count(*) FROM part)"""


@query(
    f"""{_LOAD_REPORT_SQL} SELECT dataset, CAST(sum(n_files) AS BIGINT) AS n_files,
      CAST(sum(n_rows) AS BIGINT) AS n_rows FROM counts GROUP BY ROLLUP (dataset)"""
)
def etl_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full load of the landed files into a fresh root, and its report."""
    root = scratch_path(spark, "curated")
    folder = landing_folder(spark, sf_dir)
    return etl.run_load(spark, folder, root, labels=file_labels(spark, sf_dir)).report


@query(
    f"""{_INVENTORY_SQL}, held AS (SELECT *, is_duplicate OR dataset_type IN ('desconocido', 'error') AS kept_out FROM inventory)
    SELECT filename, dataset_type AS dataset, year, CASE WHEN kept_out THEN 'held' ELSE 'loaded' END AS status,
      CASE WHEN kept_out THEN 0 ELSE nrows END AS nrows FROM held"""
)
def load_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of every landed vintage, from the status table that the load keeps."""
    root, _ = load_once(spark, sf_dir)
    return etl.read_status(spark, root).select("filename", "dataset", "year", "status", "nrows")


@query(
    """SELECT CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderpriority END AS areag, o_orderstatus AS caudef,
      CAST(o_custkey AS DOUBLE) + CASE WHEN o_orderstatus = 'P' THEN 0.5 ELSE 0 END AS edadif,
      CASE WHEN o_orderstatus = 'P' THEN 'x' || o_custkey ELSE CAST(o_custkey AS VARCHAR) END AS sexo, count(*) AS n
    FROM orders GROUP BY ALL"""
)
def drifted_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One vintage whose part files differ in columns and types: whole, fractional and text values, one column missing.

    Whole values are as narrow as they fit, so that a part of small keys has a narrower type than one of large keys.
    """
    folder = f"{scratch_path(spark, 'parts')}/2012-deaths.parquet"
    orders = table(spark, sf_dir, "orders")
    first, other, last = "o_orderstatus <=> 'F'", "NOT (o_orderstatus <=> 'F' OR o_orderstatus <=> 'P')", "o_orderstatus <=> 'P'"
    small, medium = "coalesce(o_custkey BETWEEN -32768 AND 32767, true)", "coalesce(o_custkey BETWEEN -2147483648 AND 2147483647, true)"
    area = "o_orderpriority AS areag"
    shapes = (
        (f"{first} AND {medium}", "CAST(o_custkey AS INT) AS edadif", "CAST(o_custkey AS INT) AS sexo"),
        (f"{first} AND NOT {medium}", "o_custkey AS edadif", "o_custkey AS sexo"),
        (f"{other} AND {small}", "o_custkey AS edadif", "CAST(o_custkey AS SMALLINT) AS sexo", area),
        (f"{other} AND NOT {small}", "o_custkey AS edadif", "o_custkey AS sexo", area),
        (last, "o_custkey + 0.5D AS edadif", "'x' || o_custkey AS sexo", area),
    )
    for rows, *cols in shapes:
        part = orders.where(rows).selectExpr("o_orderstatus AS caudef", *cols)
        part.write.mode("append").parquet(folder)
    return count_by(landing.read_vintage(spark, folder), "areag", "caudef", "edadif", "sexo")


@query(f"WITH {harmonised_sql(DEATHS_FILE_SQL, decoded=True)} SELECT * FROM harmonised")
def curated_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deaths read back after the load, every column."""
    root, _ = load_once(spark, sf_dir)
    return curated.read_curated(spark, root, "defunciones")


@query(
    """SELECT libras, onzas, sexo, tipar, anioreg, _year, n FROM (
      SELECT floor(l_quantity / 5) AS libras, round(l_tax * 100, 4) AS onzas,
        CASE l_linestatus WHEN 'F' THEN 'Mujer' ELSE 'Hombre' END AS sexo, l_returnflag AS tipar,
        CAST(2019 AS DOUBLE) AS anioreg, CAST(2019 AS SMALLINT) AS _year, count(*) AS n
      FROM lineitem GROUP BY ALL)"""
)
def curated_births(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Births after the load: coded sex decoded, year taken from the data."""
    root, _ = load_once(spark, sf_dir)
    births = rounded(curated.read_curated(spark, root, "nacimientos"))
    return count_by(births, "libras", "onzas", "sexo", "tipar", "anioreg", "_year")


def _documents(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    root, loaded = load_once(spark, sf_dir)
    return {d: curated.read_curated(spark, root, d) for d in loaded.datasets}


@query(
    f"""WITH {harmonised_sql(DEATHS_FILE_SQL, decoded=True)}
    SELECT sexo, puedif, edadif, CAST(count(*) AS BIGINT) AS n FROM harmonised GROUP BY ALL"""
)
def document_sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deaths written as JSON documents and read back by field."""
    root = scratch_path(spark, "documents")
    frames = {"defunciones": _documents(spark, sf_dir)["defunciones"]}
    documents.insert_documents(frames, root)
    back = documents.read_documents(spark, root).select(
        F.from_json("value", "sexo string, puedif string, edadif double").alias("d")
    )
    return count_by(back.select("d.*"), "sexo", "puedif", "edadif")


@query(
    f"""{_LOAD_REPORT_SQL} SELECT dataset AS collection, n_rows AS n_documents,
      CASE dataset WHEN 'nacimientos' THEN 46 WHEN 'defunciones' THEN 30
        WHEN 'defunciones_fetales' THEN 33 WHEN 'matrimonios' THEN 25 ELSE 21 END AS n_fields
    FROM counts"""
)
def store_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "documents")
    documents.insert_documents(_documents(spark, sf_dir), root)
    stats = documents.collection_stats(spark, root)
    return stats.select("collection", "n_documents", F.size("fields").alias("n_fields"))


@query("SELECT 'matrimonios' AS collection, count(*) AS n_documents FROM customer")
def reload_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Insert two collections, then reload with one: only that one is left."""
    frames = _documents(spark, sf_dir)
    root = scratch_path(spark, "documents")
    first = {d: frames[d] for d in ("divorcios", "matrimonios")}
    documents.insert_documents(first, root)
    documents.insert_documents({"matrimonios": frames["matrimonios"]}, root, reload=True)
    return count_by(documents.read_documents(spark, root), "collection").withColumnRenamed(
        "n", "n_documents"
    )


@query(
    """SELECT 'nacimientos' AS dataset_type, 'total ' || count(*) AS label FROM lineitem
    UNION ALL SELECT 'matrimonios', 'total ' || count(*) FROM customer"""
)
def metadata_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels that carry row counts; births are inserted, then replaced."""
    path = scratch_path(spark, "metadata")
    births = table(spark, sf_dir, "lineitem").count()
    weddings = table(spark, sf_dir, "customer").count()
    documents.save_metadata(
        spark, path, {"nacimientos": {"n": "old"}, "matrimonios": {"n": f"total {weddings}"}}
    )
    documents.save_metadata(spark, path, {"nacimientos": {"n": f"total {births}"}})
    stored = documents.read_metadata(spark, path)
    return stored.select("dataset_type", F.try_element_at("column_labels", F.lit("n")).alias("label"))


@query()
def storage_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, _ = load_once(spark, sf_dir)
    return curated.storage_inventory(spark, root)


@query(
    """SELECT dataset, CAST(_year AS SMALLINT) AS _year, n FROM (
    SELECT 'defunciones' AS dataset, year(o_orderdate) + 17 AS _year, count(*) AS n
    FROM orders GROUP BY ALL UNION ALL SELECT 'nacimientos', 2019, count(*) FROM lineitem
    UNION ALL SELECT 'matrimonios', 2020, count(*) FROM customer
    UNION ALL SELECT 'divorcios', 2021, count(*) FROM supplier
    UNION ALL SELECT 'defunciones_fetales', 2020, count(*) FROM part)"""
)
def stream_new_vintages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed vintages picked up by the stream instead of a full load."""
    root = scratch_path(spark, "streamed")
    stream = stream_landing(
        spark,
        landing_folder(spark, sf_dir),
        root,
        scratch_path(spark, "stream-state"),
        labels=file_labels(spark, sf_dir),
    )
    stream.awaitTermination()
    tables = [
        curated.read_curated(spark, root, d).select(F.lit(d).alias("dataset"), "_year")
        for d in specs.datasets()
    ]
    return count_by(union_vintages(tables), "dataset", "_year")


def _harmonised(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = []
    for name, years in generations(spark, sf_dir).items():
        raw = raw_deaths(spark, sf_dir, years, "CAST(year(o_orderdate) + 17 AS INT) AS y")
        frames.append(harmonize(raw, "defunciones", F.col("y"), f"generation-{name}"))
    return union_vintages(frames)


_GENERATION_SQL = """'generation-' || CASE WHEN year(o_orderdate) + 17 <= 2014 THEN '2012'
    WHEN year(o_orderdate) + 17 >= 2017 THEN '2017' ELSE '2015' END"""


@query(f"WITH {harmonised_sql(_GENERATION_SQL, decoded=False)} SELECT * FROM harmonised")
def harmonize_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three generations of raw deaths brought to the canonical table."""
    return _harmonised(spark, sf_dir)


@query(
    "SELECT CAST(year(o_orderdate) + 17 AS SMALLINT) AS _year, count(*) AS n FROM orders GROUP BY 1"
)
def harmonised_yearly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return yearly_counts(_harmonised(spark, sf_dir))


@query(
    """SELECT l_orderkey AS key, l_quantity AS a, CAST(NULL AS VARCHAR) AS b,
      CAST(NULL AS DOUBLE) AS c FROM lineitem
    UNION ALL SELECT o_orderkey, NULL, o_orderstatus, o_totalprice FROM orders"""
)
def union_by_name_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey AS key", "l_quantity AS a")
    second = table(spark, sf_dir, "orders").selectExpr(
        "o_totalprice AS c", "o_orderstatus AS b", "o_orderkey AS key"
    )
    return union_vintages([first, second])


@query(
    r"""WITH w AS (SELECT doc_id, regexp_extract_all(text, '[\p{L}\p{N}]+|[^\p{L}\p{N}]+') AS words
      FROM documents)
    SELECT doc_id, array_to_string(list_transform(words, lambda x:
      CASE WHEN left(x, 1) = 'ß' THEN 'Ss' ELSE upper(left(x, 1)) END || lower(substr(x, 2))), '')
      AS title FROM w"""
)
def title_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", text.title_case(F.col("text")).alias("title"))


@query(
    r"""SELECT c_custkey, regexp_replace(regexp_replace(trim(lower(raw)), '\s+', '_', 'g'),
      '[^a-z0-9_]', '', 'g') AS slug
    FROM (SELECT c_custkey, '  ' || c_name || '  Año (' || c_mktsegment || ') ' AS raw FROM customer)"""
)
def slug_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", "'  ' || c_name || '  Año (' || c_mktsegment || ') ' AS raw"
    )
    return raw.select("c_custkey", text.slug(F.col("raw")).alias("slug"))


_LABEL = "CASE WHEN doc_id % 3 = 0 THEN source || ' Nota: ' || text ELSE text END"


@query(
    f"""SELECT doc_id, CASE WHEN length(cut) > 40 THEN left(cut, 37) || '...' ELSE cut END AS label
    FROM (SELECT doc_id, CASE WHEN contains(raw, 'Nota:') THEN trim(split_part(raw, 'Nota:', 1))
      ELSE raw END AS cut FROM (SELECT doc_id, {_LABEL} AS raw FROM documents))"""
)
def short_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "documents").selectExpr("doc_id", f"{_LABEL} AS raw")
    return raw.select("doc_id", text.short_label(F.col("raw")).alias("label"))


_CIVIL_TEXT = """CASE o_orderpriority WHEN '1-URGENT' THEN 'Casado(A)' WHEN '2-HIGH' THEN 'Soltero(A)'
    WHEN '3-MEDIUM' THEN 'Viudo(A)' ELSE o_orderpriority END"""


@query(
    """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'Casado' WHEN '2-HIGH' THEN
      'Soltero' WHEN '3-MEDIUM' THEN 'Viudo' ELSE o_orderpriority END AS ecidif FROM orders"""
)
def dictionary_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = specs.value_dictionaries()["ecidif"]
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{_CIVIL_TEXT} AS e")
    return orders.select("o_orderkey", text.replace_values(F.col("e"), pairs).alias("ecidif"))


@query(
    """SELECT c_custkey, CASE c_nationkey WHEN 0 THEN 'Guatemala' WHEN 1 THEN 'México'
      WHEN 2 THEN 'Belice' WHEN 3 THEN 'Ignorado' ELSE CAST(c_nationkey AS VARCHAR) || '.0' END
      AS country FROM customer"""
)
def country_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = "CASE c_nationkey WHEN 0 THEN 320 WHEN 1 THEN 484 WHEN 2 THEN 84 WHEN 3 THEN 9999 ELSE c_nationkey END"
    coded = table(spark, sf_dir, "customer").selectExpr("c_custkey", f"CAST({code} AS DOUBLE) AS c")
    name = text.replace_values(F.col("c").cast("string"), specs.country_names())
    return coded.select("c_custkey", name.alias("country"))


@query(
    """SELECT c_custkey, coalesce(n_name, CAST(c_nationkey AS VARCHAR)) AS nation FROM customer
    LEFT JOIN (SELECT * FROM nation WHERE n_regionkey < 3) ON c_nationkey = n_nationkey"""
)
def lookup_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dictionary kept as a table: a left join that keeps unmatched values."""
    known = table(spark, sf_dir, "nation").where("n_regionkey < 3")
    pairs = known.selectExpr("n_nationkey AS key", "n_name AS value")
    people = table(spark, sf_dir, "customer").selectExpr("c_custkey", "c_nationkey AS nation")
    return decode.replace_by_join(people, "nation", pairs)


# Labels on lineitem columns: numeric codes that cover most rows, rare sentinels, text codes.
LINE_LABELS = {
    "L_LINENUMBER": {1: "uno", 2: "dos", 3: "tres", 4: "cuatro", 5: "cinco"},
    "l_quantity": {49: "No Indica", 50: "Ignorado"},
    "l_returnflag": {"A": "Activo", "R": "Retirado"},
    "not_there": {1: "x"},
}
_LINE_COLUMNS = ("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus")


@query(
    """SELECT 'l_linenumber' AS "column", count(l_linenumber) AS n_valid,
      count(*) FILTER (l_linenumber <= 5) AS n_labelled,
      round(count(*) FILTER (l_linenumber <= 5) / count(l_linenumber), 4) AS ratio FROM lineitem
    UNION ALL SELECT 'l_quantity', count(l_quantity), count(*) FILTER (l_quantity >= 49),
      round(count(*) FILTER (l_quantity >= 49) / count(l_quantity), 4) FROM lineitem
    UNION ALL SELECT 'l_returnflag', count(l_returnflag),
      count(*) FILTER (l_returnflag IN ('A', 'R')),
      round(count(*) FILTER (l_returnflag IN ('A', 'R')) / count(l_returnflag), 4) FROM lineitem"""
)
def label_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(decode.label_ratio(table(spark, sf_dir, "lineitem"), LINE_LABELS))


@query(
    """SELECT l_orderkey, CASE l_linenumber WHEN 1 THEN 'uno' WHEN 2 THEN 'dos' WHEN 3 THEN 'tres'
      WHEN 4 THEN 'cuatro' WHEN 5 THEN 'cinco' ELSE CAST(l_linenumber AS VARCHAR) END AS l_linenumber,
      CASE WHEN l_quantity >= 49 THEN NULL ELSE l_quantity END AS l_quantity,
      CASE l_returnflag WHEN 'A' THEN 'Activo' WHEN 'R' THEN 'Retirado' ELSE l_returnflag END
      AS l_returnflag, l_linestatus FROM lineitem"""
)
def apply_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decode lineitem: two labelled columns become text, rare quantity codes become NULL."""
    return decode.apply_labels(table(spark, sf_dir, "lineitem").select(*_LINE_COLUMNS), LINE_LABELS)


@query(
    """SELECT l_orderkey, CASE l_linenumber WHEN 1 THEN 'uno' WHEN 2 THEN 'dos' WHEN 3 THEN 'tres'
      WHEN 4 THEN 'cuatro' WHEN 5 THEN 'cinco' ELSE CAST(l_linenumber AS VARCHAR) END AS decoded
    FROM lineitem"""
)
def decode_categorical(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = LINE_LABELS["L_LINENUMBER"]
    decoded = decode.decode_categorical(F.col("l_linenumber"), pairs, "int")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", decoded.alias("decoded"))


@query(
    """SELECT l_orderkey, CASE l_linenumber WHEN 1 THEN 'uno' WHEN 2 THEN 'dos' WHEN 3 THEN 'tres' WHEN 4 THEN 'cuatro'
      WHEN 5 THEN 'cinco' WHEN 6 THEN '06' ELSE '7' END AS code,
      CASE l_linenumber WHEN 7 THEN NULL ELSE '0' || l_linenumber END AS sentinel FROM lineitem"""
)
def text_code_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numeric labels on text codes, however the number is written; a rare one is a sentinel."""
    code = "CASE l_linenumber WHEN 1 THEN '1.0' WHEN 2 THEN ' 2' WHEN 6 THEN '06' ELSE CAST(l_linenumber AS STRING) END"
    coded = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey", f"{code} AS code", "'0' || l_linenumber AS sentinel")
    return decode.apply_labels(coded, {"CODE": LINE_LABELS["L_LINENUMBER"], "sentinel": {7.0: "Ignorado"}})


@query(
    """SELECT l_orderkey, CASE WHEN l_quantity IN (49, 50) THEN NULL ELSE l_quantity END AS quantity
    FROM lineitem"""
)
def sentinel_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = decode.null_sentinels(F.col("l_quantity"), LINE_LABELS["l_quantity"], "double")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", kept.alias("quantity"))


_TEXT_NUMBERS = (
    "CASE WHEN o_orderkey % 10 = 0 THEN 'x' ELSE CAST(o_custkey AS STRING) END AS mostly",
    "CASE WHEN o_orderkey % 4 = 0 THEN o_orderpriority ELSE CAST(o_custkey AS STRING) END AS partly",
    "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_totalprice AS STRING) END AS sparse",
)
_TEXT_NUMBERS_SQL = f"t AS (SELECT o_orderkey, {', '.join(_TEXT_NUMBERS)} FROM orders)"


@query(
    f"""WITH {_TEXT_NUMBERS_SQL} SELECT o_orderkey, TRY_CAST(mostly AS DOUBLE) AS mostly, partly,
      TRY_CAST(sparse AS DOUBLE) AS sparse FROM t"""
)
def coerce_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "orders").selectExpr("o_orderkey", *_TEXT_NUMBERS)
    return decode.coerce_numeric(raw)


@query(
    f"WITH {_TEXT_NUMBERS_SQL}"
    + " UNION ALL ".join(
        f""" SELECT '{c}' AS "column", count({c}) AS n_valid, count(TRY_CAST({c} AS DOUBLE))
        AS n_numeric, round(count(TRY_CAST({c} AS DOUBLE)) / count({c}), 4) AS share FROM t"""
        for c in ("mostly", "partly", "sparse")
    )
)
def numeric_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "orders").selectExpr(*_TEXT_NUMBERS)
    return rounded(decode.numeric_shares(raw))


@query(
    """SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance FROM customer"""
)
def nan_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    holed = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", "CASE WHEN c_acctbal < 0 THEN double('NaN') ELSE c_acctbal END AS balance"
    )
    return decode.nan_to_null(holed)
