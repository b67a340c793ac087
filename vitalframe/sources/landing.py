"""Landing folder: discover, classify and date raw vintages, and read them.

A vintage is a direct child of the landing folder: one file, or a folder of part files when a year
is too large for one. Row counts of all vintages come from a single job.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool
from typing import TypeVar

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitalframe import specs
from vitalframe.functions.text import year_from_name

FORMATS = {".parquet": "parquet", ".orc": "orc", ".csv": "csv", ".json": "json", ".jsonl": "json"}
COPY_MARK = "(1)"
YEAR_FRAGMENTS = ("anio", "año")
# What opening or planning one broken file can raise.
READ_ERRORS = (PySparkException, Py4JJavaError, ValueError)

T = TypeVar("T")

PLAN_SCHEMA = """
    filename string, filepath string, ncols int, columns array<string>,
    column_labels map<string,string>, error string
"""


def first_line(error: Exception) -> str:
    cause = getattr(error, "java_exception", None)
    return str(cause if cause is not None else error).splitlines()[0]


def format_of(filename: str) -> str | None:
    return next((f for ext, f in FORMATS.items() if filename.lower().endswith(ext)), None)


def read_parts(spark: SparkSession, kind: str, paths: Sequence[str]) -> DataFrame:
    """Part files whose columns have one type each, by column name; absent columns are NULL.

    Spark merges the schemas of Parquet and ORC footers in one distributed job, and infers that of JSON from all parts.
    """
    if kind == "csv":
        return spark.read.option("header", True).csv(list(paths))
    return spark.read.option("mergeSchema", True).format(kind).load(list(paths))


def alike_parts(spark: SparkSession, kind: str, paths: Sequence[str]) -> list[DataFrame]:
    """Reads of part files that together hold all of them, each of parts whose schemas go together.

    Parts whose schemas Spark can't merge are halved until they merge, so a vintage with few deviating parts takes
    few reads of footers; neighbouring halves are merged again where they can be. CSV parts go by header line.
    """
    if kind == "csv":
        headers = in_parallel(lambda p: tuple(read_parts(spark, kind, [p]).columns), paths)
        alike: dict[tuple, list[str]] = {}
        for header, path in zip(headers, paths):
            alike.setdefault(header, []).append(path)
        return [read_parts(spark, kind, found) for found in alike.values()]
    groups: list[tuple[dict, list[str]]] = []

    def gather(part: Sequence[str]) -> None:
        try:
            schema = read_parts(spark, kind, part).schema
        except READ_ERRORS:
            if len(part) == 1:
                raise
            gather(part[: len(part) // 2])
            gather(part[len(part) // 2 :])
            return
        types = {f.name: f.dataType for f in schema}
        for known, members in groups:
            if all(known.get(n, t) == t for n, t in types.items()):
                known.update(types)
                members.extend(part)
                return
        groups.append((types, list(part)))

    gather(paths)
    return [read_parts(spark, kind, members) for _, members in groups]


_WHOLE = {"tinyint": 1, "smallint": 2, "int": 3, "bigint": 4}


def wider_type(a: str, b: str) -> str:
    """The narrowest type that holds the values of both; text where numbers, dates and the like meet."""
    if a == b:
        return a
    if a in _WHOLE and b in _WHOLE:
        return max(a, b, key=_WHOLE.__getitem__)
    numbers = {*_WHOLE, "float", "double"}
    if (a in numbers or a.startswith("decimal")) and (b in numbers or b.startswith("decimal")):
        return "double"
    if {a, b} <= {"date", "timestamp", "timestamp_ntz"}:
        return "timestamp" if "timestamp" in (a, b) else "timestamp_ntz"
    return "string"


def union_parts(frames: Sequence[DataFrame]) -> DataFrame:
    """Reads of one vintage as one frame: every column of any of them, in the type that holds all."""
    types: dict[str, str] = {}
    for df in frames:
        for name, kind in df.dtypes:
            types[name] = wider_type(types.get(name, kind), kind)

    def typed(df: DataFrame) -> DataFrame:
        held = set(df.columns)
        return df.select(
            *[(F.col(f"`{n}`") if n in held else F.lit(None)).cast(t).alias(n, metadata=_metadata(frames, n)) for n, t in types.items()]
        )

    union, *rest = [typed(df) for df in frames]
    for df in rest:
        union = union.unionByName(df)
    return union


def _metadata(frames: Sequence[DataFrame], name: str) -> dict:
    """Metadata of a column, where its label is, from the first frame that has any."""
    found = (df.schema[name].metadata for df in frames if name in df.columns)
    return next((m for m in found if m), {})


def read_vintage(spark: SparkSession, filepath: str) -> DataFrame:
    """Raw vintage in whatever landed format, by extension, with the columns of all its part files.

    Types that differ between parts become the narrowest that holds all, text at worst.
    """
    kind = format_of(filepath)
    if kind is None:
        raise ValueError(f"unsupported format: {filepath}")
    if kind != "csv":
        try:
            return read_parts(spark, kind, [filepath])
        except READ_ERRORS as e:
            parts = part_files(spark, filepath)
            if len(parts) < 2:
                raise e
    else:
        parts = part_files(spark, filepath)
        if len(parts) < 2:
            return read_parts(spark, kind, [filepath])
    return union_parts(alike_parts(spark, kind, parts))


def part_files(spark: SparkSession, filepath: str) -> list[str]:
    """Paths of a vintage's part files, sorted; their number doesn't grow with the rows of a part."""
    return sorted(r["path"] for r in list_files(spark, filepath).select("path").collect())


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """``(path, length)`` of every file below ``folder``; file contents are never read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    return files.load(folder).select("path", "length")


def vintage_name(path: Column, folder: str) -> Column:
    """First path element below the landing folder."""
    folder_name = folder.rstrip("/").rsplit("/", 1)[-1]
    below = F.substring_index(path, f"/{folder_name}/", -1)
    return F.substring_index(below, "/", 1)


def vintages(spark: SparkSession, folder: str) -> list[str]:
    """Names of the landed vintages, sorted; their number is years times datasets."""
    names = list_files(spark, folder).select(vintage_name(F.col("path"), folder).alias("name"))
    rows = names.distinct().where(F.lower("name").rlike(r"\.(parquet|orc|csv|json|jsonl)$"))
    return sorted(r["name"] for r in rows.collect())


def classify(columns: Column) -> Column:
    """First dataset, in priority order, having all columns of one of its signatures."""
    names = F.transform(columns, F.lower)
    verdict = F.lit(specs.UNKNOWN_DATASET)
    for dataset, signature in reversed(specs.SIGNATURES):
        wanted = F.array(*[F.lit(c) for c in signature])
        verdict = F.when(F.size(F.array_except(wanted, names)) == 0, dataset).otherwise(verdict)
    return verdict


def is_copy(filename: Column) -> Column:
    return F.contains(filename, F.lit(COPY_MARK))


def year_from_data(df: DataFrame) -> int | None:
    """Year found in the rows: of the first year-named column with a value in range, the smallest such value."""
    named = [c for c in df.columns if any(p in c.lower() for p in YEAR_FRAGMENTS)]
    if not named:
        return None
    lo, hi = specs.YEAR_RANGE
    values = [F.col(f"`{c}`").try_cast("double") for c in named]
    # NaN and fractions beyond the last year are out of range.
    inside = [F.when((v >= lo) & (v < hi + 1), F.floor(v)) for v in values]
    years = df.agg(*[F.min(y).alias(f"_y{i}") for i, y in enumerate(inside)]).first()
    return next((int(y) for y in years if y is not None), None)


def probe(spark: SparkSession, folder: str, name: str) -> tuple:
    """Plan row of one vintage from its schema alone; unreadable files carry the error."""
    path = f"{folder.rstrip('/')}/{name}"
    try:
        schema = read_vintage(spark, path).schema
    except READ_ERRORS as e:
        return (name, path, 0, [], {}, first_line(e))
    labels = {f.name: f.metadata.get("label", f.name) for f in schema}
    return (name, path, len(schema), schema.names, labels, None)


def in_parallel(step: Callable, items: Sequence) -> list:
    """Run a short driver-side step for many files; the work is waiting on file footers."""
    if not items:
        return []
    with ThreadPool(min(16, len(items))) as pool:
        return pool.map(step, items)


def scan(spark: SparkSession, folder: str) -> DataFrame:
    """Landing inventory, one row per vintage, in name order.

    ``(filename, filepath, dataset_type, year, nrows, ncols, columns, column_labels,
    is_duplicate, error)``.
    """
    names = vintages(spark, folder)
    plans = in_parallel(lambda n: probe(spark, folder, n), names)
    readable = [(p[0], p[1]) for p in plans if p[5] is None]
    found = spark.createDataFrame(plans, PLAN_SCHEMA)

    lo, hi = specs.YEAR_RANGE
    named = year_from_name(F.col("filename"), lo, hi)
    undated = {r["filename"] for r in found.where(named.isNull()).select("filename").collect()}
    probes = [(n, p) for n, p in readable if n in undated]
    years = in_parallel(lambda f: attempt(lambda: year_from_data(read_vintage(spark, f[1]))), probes)
    from_data = [(n, *y) for (n, _), y in zip(probes, years)]
    probed = spark.createDataFrame(from_data, "filename string, _data_year int, _year_error string")

    counts = row_counts(spark, readable)
    found = found.join(counts, "filename", "left").join(probed, "filename", "left")
    found = found.withColumn("error", F.coalesce("error", "_count_error", "_year_error"))
    failed = F.col("error").isNotNull()
    kind = F.when(failed, specs.ERROR_DATASET).otherwise(classify(F.col("columns")))
    year = F.when(~failed, F.coalesce(named, F.col("_data_year")))
    return found.select(
        "filename",
        "filepath",
        kind.alias("dataset_type"),
        year.alias("year"),
        F.when(failed, F.lit(0)).otherwise(F.coalesce("nrows", F.lit(0))).cast("bigint").alias("nrows"),
        "ncols",
        "columns",
        "column_labels",
        is_copy(F.col("filename")).alias("is_duplicate"),
        "error",
    ).orderBy("filename")


def attempt(step: Callable[[], T]) -> tuple[T | None, str | None]:
    """The step's result and None, or None and the first line of its reading error."""
    try:
        return step(), None
    except READ_ERRORS as e:
        return None, first_line(e)


def row_counts(spark: SparkSession, files: Sequence[tuple[str, str]]) -> DataFrame:
    """``(filename, nrows, _count_error)`` of all vintages in one job that reads no columns.

    If that job meets a damaged file, each vintage is counted by itself, so only those that fail have no count.
    """

    def counted(some: Sequence[tuple[str, str]]) -> list[tuple]:
        tagged = [read_vintage(spark, p).select(F.lit(n).alias("filename")) for n, p in some]
        union, *rest = tagged
        for frame in rest:
            union = union.union(frame)
        # a row per vintage
        return [tuple(r) for r in union.groupBy("filename").agg(F.count("*").alias("nrows")).collect()]

    rows, error = attempt(lambda: counted(files)) if files else ([], None)
    if error is None:
        found = [(n, c, None) for n, c in rows]
    else:
        singles = in_parallel(lambda f: attempt(lambda: counted([f])), files)
        found = [(name, rows[0][1] if rows else 0, e) for (name, _), (rows, e) in zip(files, singles)]
    return spark.createDataFrame(found, "filename string, nrows bigint, _count_error string")


def unique_files(inventory: DataFrame) -> DataFrame:
    """Inventory without copies of the same download."""
    return inventory.where(~F.col("is_duplicate"))


def loadable_files(inventory: DataFrame, dataset: str | None = None) -> DataFrame:
    """Files that go on to loading: no copies, nothing unreadable or unknown, one type if asked."""
    kept = unique_files(inventory).where(
        ~F.col("dataset_type").isin(specs.ERROR_DATASET, specs.UNKNOWN_DATASET)
    )
    return kept.where(F.col("dataset_type") == dataset) if dataset else kept


def quarantined_files(inventory: DataFrame) -> DataFrame:
    """Files kept out of the load, with the reason."""
    reason = F.when(F.col("is_duplicate"), "copy").when(
        F.col("dataset_type") == specs.UNKNOWN_DATASET, "unknown columns"
    )
    return inventory.select(
        "filename", F.coalesce(reason, F.col("error")).alias("reason")
    ).where(F.col("reason").isNotNull())


def mark_latest(files: DataFrame) -> DataFrame:
    """Add ``is_latest``: of several files with the same type and year, the last by name.

    Nothing says that undated files cover the same year, so all of them are latest.
    """
    same = Window.partitionBy("dataset_type", "year").orderBy(F.desc("filename"))
    latest = F.col("year").isNull() | (F.row_number().over(same) == 1)
    return files.withColumn("is_latest", latest)


def scan_summary(inventory: DataFrame) -> DataFrame:
    """``(dataset_type, n_files, years, first_year, last_year, total_rows)`` without copies."""
    return (
        unique_files(inventory)
        .groupBy("dataset_type")
        .agg(
            F.count("*").alias("n_files"),
            F.array_sort(F.collect_list("year")).alias("years"),
            F.min("year").alias("first_year"),
            F.max("year").alias("last_year"),
            F.sum("nrows").alias("total_rows"),
        )
    )
