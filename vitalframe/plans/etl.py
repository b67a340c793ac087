"""Full load: landing folder to curated tables, documents and metadata.

Every vintage is decoded, harmonised and written by itself, side by side with the others: its write has a
staging folder and a commit of its own, so a damaged file costs its vintage and nothing else. What a write
counted is kept in a status table; reports come from there, not from reading back.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from vitalframe.functions.text import slug
from vitalframe.operators.decode import apply_labels, nan_to_null
from vitalframe.operators.harmonize import alias_clashes, harmonize, losses, union_vintages
from vitalframe.sources import curated, documents, landing
from vitalframe.sources.scratch import materialise

# File name -> column -> code -> label.
FileLabels = Mapping[str, Mapping[str, Mapping[object, str]]]

STATUS_FOLDER = "load_status"
STATUS_SCHEMA = """
    filename string, dataset string, year int, status string, nrows bigint, lost map<string,bigint>,
    clashes map<string,bigint>, reason string
"""
LOADED, SUPERSEDED, HELD, FAILED = "loaded", "superseded", "held", "failed"


@dataclass
class LoadResult:
    """What a load did. ``status`` has a row per vintage, ``report`` the loaded rows per dataset; both are lazy."""

    report: DataFrame
    datasets: list[str]
    status: DataFrame | None = None
    errors: dict[str, str] = field(default_factory=dict)
    clashes: dict[str, dict[str, list[str]]] = field(default_factory=dict)
    superseded: list[str] = field(default_factory=list)
    n_documents: int = 0


@dataclass
class Vintage:
    """A vintage on its way: its plan row, what became of it, and its rows if they wait for others."""

    filename: str
    filepath: str
    dataset: str
    year: int | None
    columns: Mapping[str, str] = field(default_factory=dict)
    status: str = FAILED
    nrows: int = 0
    lost: dict[str, int] = field(default_factory=dict)
    clashing: dict[str, int] = field(default_factory=dict)
    clashes: dict[str, list[str]] = field(default_factory=dict)
    reason: str | None = None
    staged: DataFrame | None = None

    def row(self) -> tuple:
        return (self.filename, self.dataset, self.year, self.status, self.nrows, self.lost, self.clashing, self.reason)


def labels_from_frame(labels: DataFrame) -> dict[str, dict[str, dict[float, str]]]:
    """Label table ``(filename, column, code, label)`` as nested dictionaries.

    A dictionary table describes columns, not rows, so it does not grow with the data.
    """
    nested: dict[str, dict[str, dict[float, str]]] = {}
    for r in labels.select("filename", "column", "code", "label").collect():
        nested.setdefault(r[0], {}).setdefault(r[1], {})[r[2]] = r[3]
    return nested


def column_labels(spark: SparkSession, vintages: Sequence[Vintage]) -> dict[str, dict[str, str]]:
    """Per dataset, column labels keyed by slug of the column name; one job. The last file by name that has a column labels it."""
    rows = [(v.dataset, v.filename, name, label) for v in vintages for name, label in v.columns.items()]
    frame = spark.createDataFrame(rows, "dataset string, filename string, name string, label string")
    last = frame.groupBy("dataset", slug(F.col("name")).alias("slug")).agg(F.max_by("label", F.struct("filename", "name")).alias("label"))
    out: dict[str, dict[str, str]] = {}
    for r in last.collect():  # a row per declared column
        out.setdefault(r["dataset"], {})[r["slug"]] = r["label"]
    return out


def load_vintage(spark: SparkSession, vintage: Vintage, labels: FileLabels, root: str) -> None:
    """Decode, harmonise and write one vintage, counting as it is written; what goes wrong is its status.

    A dated vintage replaces its year. An undated one is only staged: it shares its partition with others.
    """
    try:
        raw = nan_to_null(landing.read_vintage(spark, vintage.filepath))
        decoded = apply_labels(raw, labels.get(vintage.filename, {}))
        vintage.clashes = alias_clashes(decoded, vintage.dataset)
        counts = losses(decoded, vintage.dataset)
        seen = Observation()
        watched = decoded.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(name) for name, c in counts.items()])
        shaped = harmonize(watched, vintage.dataset, vintage.year, vintage.filename)
        if vintage.year is None:
            vintage.staged = materialise(shaped, "staged")
        else:
            curated.write_curated(shaped, root, vintage.dataset)
        found = seen.get
    except landing.READ_ERRORS as e:
        vintage.reason = landing.first_line(e)
        return
    vintage.status, vintage.nrows = LOADED, found["rows"]
    vintage.lost = {k.removeprefix("lost:"): n for k, n in found.items() if k.startswith("lost:") and n}
    vintage.clashing = {k.removeprefix("clash:"): n for k, n in found.items() if k.startswith("clash:") and n}


def load_side_by_side(spark: SparkSession, vintages: Sequence[Vintage], labels: FileLabels, root: str) -> None:
    """Load vintages side by side, then publish a dataset's undated ones together."""
    landing.in_parallel(lambda v: load_vintage(spark, v, labels, root), vintages)
    for dataset in sorted({v.dataset for v in vintages}):
        staged = [v for v in vintages if v.dataset == dataset and v.staged is not None]
        if staged:
            frames = [v.staged for v in staged]
            curated.write_curated(union_vintages(frames), root, dataset, [v.filename for v in staged])


def status_frame(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    return spark.createDataFrame(list(rows), STATUS_SCHEMA)


def save_status(spark: SparkSession, root: str, rows: Sequence[tuple]) -> DataFrame:
    """Append a load's status rows to the status table beside the datasets, and return them."""
    frame = status_frame(spark, rows)
    frame.withColumn("loaded_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{root.rstrip('/')}/{STATUS_FOLDER}")
    return frame


def read_status(spark: SparkSession, root: str) -> DataFrame:
    """Status rows of every load of this root, with ``loaded_at``."""
    return spark.read.schema(f"{STATUS_SCHEMA}, loaded_at timestamp").parquet(f"{root.rstrip('/')}/{STATUS_FOLDER}")


def quarantine_status(inventory: DataFrame) -> list[tuple]:
    """Status rows of the files that a scan keeps out of the load; a row per file reaches the driver."""
    held = landing.quarantined_files(inventory).join(inventory.select("filename", "dataset_type", "year"), "filename")
    return [(r["filename"], r["dataset_type"], r["year"], HELD, 0, {}, {}, r["reason"]) for r in held.orderBy("filename").collect()]


def load_report(status: DataFrame) -> DataFrame:
    """``(dataset, n_files, n_rows)`` of what was loaded, plus a total row with a NULL dataset."""
    return status.where(F.col("status") == LOADED).rollup("dataset").agg(F.count("*").alias("n_files"), F.sum("nrows").alias("n_rows"))


def loaded_rows(spark: SparkSession, root: str, vintages: Sequence[Vintage]) -> dict[str, DataFrame]:
    """Per dataset, the curated rows of loaded vintages: whole years, and undated rows by file."""
    frames = {}
    for dataset in sorted({v.dataset for v in vintages if v.status == LOADED}):
        mine = [v for v in vintages if v.dataset == dataset and v.status == LOADED]
        years = sorted({v.year for v in mine if v.year is not None})
        undated = [v.filename for v in mine if v.year is None]
        wanted = F.col("_year").isin(*years) if years else F.lit(False)
        if undated:
            wanted = wanted | (F.col("_year").isNull() & F.col("_source_file").isin(*undated))
        frames[dataset] = curated.read_curated(spark, root, dataset).where(wanted)
    return frames


def finish(spark: SparkSession, root: str, vintages: Sequence[Vintage], others: Sequence[tuple]) -> LoadResult:
    """Save the status of a load and say what it did."""
    loaded = [v for v in vintages if v.status == LOADED]
    status = save_status(spark, root, [*(v.row() for v in vintages), *others])
    return LoadResult(
        report=load_report(status),
        datasets=sorted({v.dataset for v in loaded}),
        status=status,
        errors={v.filename: v.reason for v in vintages if v.status == FAILED},
        clashes={v.filename: v.clashes for v in vintages if v.clashes},
        superseded=[v.filename for v in vintages if v.status == SUPERSEDED],
    )


def run_load(
    spark: SparkSession,
    landing_dir: str,
    curated_dir: str,
    dataset: str | None = None,
    labels: FileLabels | None = None,
    documents_dir: str | None = None,
    metadata_dir: str | None = None,
    reload: bool = False,
) -> LoadResult:
    """Scan, filter, decode, harmonise and write every landed vintage.

    A file that can't be read, at first sight or while it is written, is reported and the others are loaded. Documents
    are written only when a folder for them is given; ``reload`` then drops all stored documents first.
    """
    inventory = materialise(landing.scan(spark, landing_dir), "inventory")
    candidates = landing.mark_latest(landing.loadable_files(inventory, dataset))
    everything = [
        Vintage(r["filename"], r["filepath"], r["dataset_type"], r["year"], r["column_labels"], status=FAILED if r["is_latest"] else SUPERSEDED)
        for r in candidates.orderBy("filename").collect()
    ]
    if not everything:
        raise ValueError(f"no loadable files for {dataset or 'any dataset'} in {landing_dir}")
    files = [v for v in everything if v.status != SUPERSEDED]
    load_side_by_side(spark, files, labels or {}, curated_dir)
    result = finish(spark, curated_dir, everything, quarantine_status(inventory))
    if documents_dir:
        tables = loaded_rows(spark, curated_dir, files)
        if tables:
            result.n_documents = documents.insert_documents(tables, documents_dir, reload)
    if metadata_dir:
        documents.save_metadata(spark, metadata_dir, column_labels(spark, files))
    return result
