import pytest
from helpers import rows
from pyspark.sql import functions as F

from vitalframe.operators.counts import count_by
from vitalframe.plans import etl
from vitalframe.plans.api import Registry
from vitalframe.sources import curated, documents, landing
from vitalframe.streaming.landing_stream import load_vintages, stream_landing


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("raw files")

    def put(name, data, schema):
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{root}/{name}")

    deaths = "CauDef string, EdadIf double, Sexo double, PerDif string"
    put("2012-deaths.parquet", [("u071", 34.0, 1.0, "1 año y má"), ("j189", 999.0, 2.0, None), ("x599", 40.0, 1.0, None)], deaths)
    put("2012-deaths (1).parquet", [("u071", 1.0, 1.0, None)], deaths)
    put("2013-a-deaths.parquet", [("a", 1.0, 1.0, None)], deaths)
    put("2013-b-deaths.parquet", [("b", 2.0, 2.0, None), ("c", 3.0, 2.0, None)], deaths)
    put("births.parquet", [(7.0, 8.0, "f", "Simple", 2019.0)], "libras double, onzas double, sexo string, tipar string, anioreg double")
    put("1999-x.parquet", [("a", 1.0, 2.0)], "clauni string, edadhom double, edadmuj double")
    put("2020-y.parquet", [(1.0, 2.0, "d", "e")], "edadhom double, edadmuj double, ocuhom string, ocumuj string")
    put("2020-z.parquet", [(20.0, "p", "s", 30.0)], "semges double, caudef string, tipar string, edadm double")
    put("2021-q.parquet", [(1, 2)], "a int, b int")
    (root / "2021-bad.parquet").write_text("not parquet at all")
    (root / "notes.txt").write_text("ignored")
    return str(root)


LABELS = {
    "2012-deaths.parquet": {"sexo": {1: "Masculino", 2: "Femenino"}, "EDADIF": {999: "Ignorado"}},
}


def test_inventory(spark, folder):
    got = {r["filename"]: r for r in landing.scan(spark, folder).collect()}
    kinds = {n: (r["dataset_type"], r["year"], r["nrows"], r["is_duplicate"]) for n, r in got.items()}
    assert kinds == {
        "2012-deaths.parquet": ("defunciones", 2012, 3, False),
        "2012-deaths (1).parquet": ("defunciones", 2012, 1, True),
        "2013-a-deaths.parquet": ("defunciones", 2013, 1, False),
        "2013-b-deaths.parquet": ("defunciones", 2013, 2, False),
        "births.parquet": ("nacimientos", 2019, 1, False),
        "1999-x.parquet": ("matrimonios", None, 1, False),
        "2020-y.parquet": ("divorcios", 2020, 1, False),
        "2020-z.parquet": ("defunciones_fetales", 2020, 1, False),
        "2021-q.parquet": ("desconocido", 2021, 1, False),
        "2021-bad.parquet": ("error", None, 0, False),
    }
    assert got["2021-bad.parquet"]["error"]
    assert got["births.parquet"]["columns"][0] == "libras"


def test_summary_and_quarantine(spark, folder):
    inventory = landing.scan(spark, folder)
    summary = {r["dataset_type"]: r for r in landing.scan_summary(inventory).collect()}
    assert (summary["defunciones"]["n_files"], summary["defunciones"]["total_rows"]) == (3, 6)
    assert summary["defunciones"]["years"] == [2012, 2013, 2013]
    held = {r["filename"] for r in landing.quarantined_files(inventory).collect()}
    assert held == {"2012-deaths (1).parquet", "2021-q.parquet", "2021-bad.parquet"}


@pytest.fixture(scope="module")
def loaded(spark, folder, tmp_path_factory):
    base = tmp_path_factory.mktemp("out")
    result = etl.run_load(
        spark, folder, f"{base}/curated", labels=LABELS,
        documents_dir=f"{base}/documents", metadata_dir=f"{base}/metadata", reload=True,
    )
    return base, result


def test_load_report(loaded):
    _, result = loaded
    assert result.superseded == ["2013-a-deaths.parquet"]
    assert result.n_documents == 9
    assert rows(result.report) == [
        (None, 6, 9), ("defunciones", 2, 5), ("defunciones_fetales", 1, 1),
        ("divorcios", 1, 1), ("matrimonios", 1, 1), ("nacimientos", 1, 1),
    ]


def test_curated_values(spark, loaded):
    base, _ = loaded
    deaths = curated.read_curated(spark, f"{base}/curated", "defunciones").where("_year = 2012")
    assert rows(deaths, "caudef", "edadif", "sexo", "perdif") == [
        ("J189", None, "Mujer", None), ("U071", 34.0, "Hombre", "1 Año Y Más"), ("X599", 40.0, "Hombre", None),
    ]
    weddings = curated.read_curated(spark, f"{base}/curated", "matrimonios")
    assert weddings.first()["_year"] is None


def test_other_years_survive_a_partial_load(spark, loaded):
    base, _ = loaded
    root = f"{base}/partial"
    full = curated.read_curated(spark, f"{base}/curated", "defunciones")
    curated.write_curated(full, root, "defunciones")
    curated.write_curated(full.where("_year = 2013").limit(1), root, "defunciones")
    assert rows(count_by(curated.read_curated(spark, root, "defunciones"), "_year")) == [(2012, 3), (2013, 1)]


def test_year_filter_prunes_partitions(spark, loaded):
    base, _ = loaded
    df = curated.read_curated(spark, f"{base}/curated", "defunciones").where("_year = 2012").select("sexo")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_year" in plan
    assert "ReadSchema: struct<sexo:string>" in plan


def test_query_interface(spark, loaded):
    base, _ = loaded
    api = Registry(spark, f"{base}/curated")
    assert api.list_datasets() == ["nacimientos", "defunciones", "defunciones_fetales", "matrimonios", "divorcios"]
    assert rows(api.yearly_counts("defunciones")) == [(2012, 3), (2013, 2)]
    assert rows(api.sql("SELECT count(*) FROM defunciones WHERE sexo = 'Hombre'")) == [(2,)]
    assert rows(api.load("defunciones", columns=["caudef"], where="_year = 2013")) == [("B",), ("C",)]
    assert api.load("defunciones", sample_n=2).count() == 2
    assert api.load("defunciones", where="_year = 2012", sample_n=3, sample_before_filter=False).count() == 3
    assert api.sample("defunciones", 100).count() == 5
    assert api.fields("defunciones")[:2] == ["depreg", "mupreg"]
    assert api.column_labels("defunciones")["sexo"] == "Sexo del difunto"
    assert api.describe("defunciones").where("column_name = 'edadif'").first()["avg"] == pytest.approx(79 / 4)
    assert api.to_arrow(api.yearly_counts("defunciones")).num_rows == 2
    assert list(api.to_pandas(api.yearly_counts("defunciones"))["n"]) == [3, 2]
    storage = {r["dataset"]: r["n_files"] for r in api.storage().collect()}
    assert storage["defunciones"] >= 2 and len(storage) == 5
    counted = dict(rows(api.table_counts().where("dataset IS NOT NULL")))
    assert counted["defunciones"] == 5
    assert Registry(spark, f"{base}/nowhere").list_datasets() == []


def test_documents(spark, loaded):
    base, _ = loaded
    stats = {r["collection"]: r for r in documents.collection_stats(spark, f"{base}/documents").collect()}
    assert stats["defunciones"]["n_documents"] == 5
    assert stats["defunciones"]["fields"][-2:] == ["_year", "_source_file"]
    assert stats["matrimonios"]["n_documents"] == 1
    meta = documents.read_metadata(spark, f"{base}/metadata")
    assert meta.where("dataset_type = 'nacimientos'").first()["column_labels"]["libras"] == "libras"


def test_metadata_upsert_replaces_one_key(spark, tmp_path):
    path = str(tmp_path / "meta")
    documents.save_metadata(spark, path, {"a": {"x": "1"}, "b": {"x": "2"}})
    documents.save_metadata(spark, path, {"a": {"y": "3"}})
    assert {r["dataset_type"]: r["column_labels"] for r in documents.read_metadata(spark, path).collect()} == {
        "a": {"y": "3"}, "b": {"x": "2"},
    }


def test_document_batches(spark, tmp_path):
    df = spark.range(25).coalesce(1).withColumn("x", F.lit(float("nan")))
    assert documents.insert_documents({"c": df}, str(tmp_path / "d"), batch_size=10) == 25
    files = [p for p in (tmp_path / "d" / "collection=c").iterdir() if p.name.endswith(".txt")]
    assert len(files) == 3
    assert documents.read_documents(spark, str(tmp_path / "d")).first()["value"].endswith('"x":null}')


def test_unknown_dataset_is_reported(spark, folder, tmp_path):
    with pytest.raises(ValueError):
        etl.run_load(spark, folder, str(tmp_path), dataset="nothing")


def test_stream_loads_new_files(spark, folder, tmp_path):
    root, state = str(tmp_path / "curated"), str(tmp_path / "state")
    stream_landing(spark, folder, root, state, LABELS, files_per_batch=3).awaitTermination()
    deaths = curated.read_curated(spark, root, "defunciones")
    assert rows(count_by(deaths, "_year")) == [(2012, 3), (2013, 2)]
    # Nothing new: a second run leaves everything as it is.
    stream_landing(spark, folder, root, state, LABELS).awaitTermination()
    assert rows(count_by(deaths, "_year")) == [(2012, 3), (2013, 2)]


def test_scratch_needs_a_shared_folder_on_a_cluster():
    from types import SimpleNamespace

    from vitalframe.sources.scratch import scratch_root

    def session(master, setting=None):
        conf = SimpleNamespace(get=lambda key, default=None: setting)
        context = SimpleNamespace(master=master, applicationId=master, getConf=lambda: conf)
        return SimpleNamespace(conf=conf, sparkContext=context)

    assert scratch_root(session("yarn", "/shared/tmp/")) == "/shared/tmp"
    assert scratch_root(session("local[2]")) == scratch_root(session("local[2]"))
    with pytest.raises(RuntimeError):
        scratch_root(session("yarn"))


def test_labels_table(spark):
    df = spark.createDataFrame([("f", "c", 1.0, "x"), ("f", "c", 2.0, "y")], "filename string, column string, code double, label string")
    assert etl.labels_from_frame(df) == {"f": {"c": {1.0: "x", 2.0: "y"}}}


def test_not_a_number_is_missing(spark, tmp_path):
    """NaN in a year column leaves the vintage undated at worst; NaN values load as NULL."""
    data = [(float("nan"), 8.0, "f", "Simple", float("nan")), (7.0, 8.0, "f", "Simple", 2019.0)]
    births = spark.createDataFrame(data, "libras double, onzas double, sexo string, tipar string, anioreg double")
    births.where("isnan(anioreg)").coalesce(1).write.parquet(f"{tmp_path}/raw/births.parquet")
    births.coalesce(1).write.parquet(f"{tmp_path}/raw/2019-births.parquet")
    years = {r["filename"]: r["year"] for r in landing.scan(spark, f"{tmp_path}/raw").collect()}
    assert years == {"births.parquet": None, "2019-births.parquet": 2019}
    etl.run_load(spark, f"{tmp_path}/raw", f"{tmp_path}/curated", "nacimientos")
    loaded = curated.read_curated(spark, f"{tmp_path}/curated", "nacimientos").where("_year = 2019")
    assert sorted((r["libras"] for r in loaded.select("libras").collect()), key=str) == [7.0, None]


BIRTHS = "libras double, onzas double, sexo string, tipar string, anioreg double"


def test_year_from_all_rows(spark, tmp_path):
    """The year may stand behind any number of missing values; the smallest one in range counts."""
    years = [None, float("nan"), 99.0] * 5 + [2021.0, 2020.0, float("inf")]
    data = [(1.0, 2.0, "f", "Simple", y) for y in years]
    frame = spark.createDataFrame(data, BIRTHS).coalesce(1)
    assert landing.year_from_data(frame) == 2020
    assert landing.year_from_data(frame.limit(15)) is None


def test_undated_files_all_stay(spark, tmp_path):
    """Undated vintages of one dataset never replace each other, in a full load or batch by batch."""
    for i, name in enumerate("abc"):
        data = [(float(i), 8.0, "f", "Simple", None)]
        spark.createDataFrame(data, BIRTHS).coalesce(1).write.parquet(f"{tmp_path}/raw/{name}.parquet")

    def loaded(root):
        return rows(curated.read_curated(spark, root, "nacimientos"), "_source_file", "_year", "libras")

    want = [("a.parquet", None, 0.0), ("b.parquet", None, 1.0), ("c.parquet", None, 2.0)]
    full = f"{tmp_path}/full"
    for _ in range(2):
        assert etl.run_load(spark, f"{tmp_path}/raw", full).superseded == []
        assert loaded(full) == want
    streamed = f"{tmp_path}/streamed"
    stream_landing(spark, f"{tmp_path}/raw", streamed, f"{tmp_path}/state", files_per_batch=1).awaitTermination()
    assert loaded(streamed) == want


@pytest.mark.parametrize("order", ["ab", "ba"])
def test_batches_do_not_decide_the_year(spark, folder, tmp_path, order):
    """The last file by name keeps the year, also when the other one comes in a later batch."""
    for letter in order:
        load_vintages(spark, folder, [f"2013-{letter}-deaths.parquet"], str(tmp_path))
    deaths = curated.read_curated(spark, str(tmp_path), "defunciones")
    assert rows(deaths, "_source_file", "caudef") == [("2013-b-deaths.parquet", "B"), ("2013-b-deaths.parquet", "C")]


def test_stream_of_single_files_equals_a_full_load(spark, folder, tmp_path):
    root = str(tmp_path / "curated")
    stream_landing(spark, folder, root, str(tmp_path / "state"), LABELS, files_per_batch=1).awaitTermination()
    deaths = curated.read_curated(spark, root, "defunciones")
    assert rows(count_by(deaths, "_source_file")) == [("2012-deaths.parquet", 3), ("2013-b-deaths.parquet", 2)]


DEATHS = "caudef string, edadif double, sexo double, perdif string"


def damage_pages(folder):
    """Overwrite every part's pages, and leave its footer whole."""
    for part in folder.glob("part-*"):
        data = bytearray(part.read_bytes())
        pages = len(data) - 8 - int.from_bytes(data[-8:-4], "little")
        data[4:pages] = b"\xff" * (pages - 4)
        part.write_bytes(data)
        (folder / f".{part.name}.crc").unlink()


def test_a_damaged_page_costs_its_vintage_only(spark, tmp_path):
    """The others are loaded, what was stored for the year stays, and the status table names the file."""
    raw, root = tmp_path / "raw", str(tmp_path / "curated")
    for year in (2012, 2013, 2014):
        data = [("a", float(i), 1.0, "x") for i in range(5000)]
        spark.createDataFrame(data, DEATHS).coalesce(1).write.parquet(f"{raw}/{year}-d.parquet")
    spark.createDataFrame([(1.0, 8.0, "f", "Simple", None)], BIRTHS).coalesce(1).write.parquet(f"{raw}/births.parquet")
    spark.createDataFrame([(float(i), 8.0, "f", "Simple", 2019.0) for i in range(5000)], BIRTHS).coalesce(1).write.parquet(f"{raw}/more.parquet")
    (raw / "2015-bad.parquet").write_text("not parquet at all")
    assert etl.run_load(spark, str(raw), root).errors == {}
    damage_pages(raw / "2013-d.parquet")
    damage_pages(raw / "more.parquet")
    result = etl.run_load(spark, str(raw), root)
    assert set(result.errors) == {"2013-d.parquet"} and result.errors["2013-d.parquet"]
    status = {r["filename"]: (r["status"], r["nrows"]) for r in result.status.collect()}
    assert status == {
        "2012-d.parquet": ("loaded", 5000), "2013-d.parquet": ("failed", 0), "2014-d.parquet": ("loaded", 5000),
        "births.parquet": ("loaded", 1), "more.parquet": ("held", 0), "2015-bad.parquet": ("held", 0),
    }
    assert rows(result.report) == [(None, 3, 10001), ("defunciones", 2, 10000), ("nacimientos", 1, 1)]
    deaths = curated.read_curated(spark, root, "defunciones")
    assert rows(count_by(deaths, "_year")) == [(2012, 5000), (2013, 5000), (2014, 5000)]
    saved = etl.read_status(spark, root)
    assert saved.where("status = 'failed'").count() == 1 and saved.where("status = 'held'").count() == 3
    held = {r["filename"]: r["reason"] for r in landing.quarantined_files(landing.scan(spark, str(raw))).collect()}
    assert set(held) == {"more.parquet", "2015-bad.parquet"} and all(held.values())


def test_stream_keeps_the_status_of_every_file(spark, tmp_path):
    raw, root = tmp_path / "raw", str(tmp_path / "curated")
    for year in (2012, 2013):
        spark.createDataFrame([("a", float(i), 1.0, "x") for i in range(5000)], DEATHS).coalesce(1).write.parquet(f"{raw}/{year}-d.parquet")
    damage_pages(raw / "2013-d.parquet")
    spark.createDataFrame([(1, 2)], "a int, b int").coalesce(1).write.parquet(f"{raw}/2016-u.parquet")
    (raw / "2015-bad.parquet").write_text("not parquet at all")
    stream_landing(spark, str(raw), root, str(tmp_path / "state"), files_per_batch=2).awaitTermination()
    status = {r["filename"]: r["status"] for r in etl.read_status(spark, root).collect()}
    assert status == {"2012-d.parquet": "loaded", "2013-d.parquet": "failed", "2016-u.parquet": "held", "2015-bad.parquet": "held"}


def test_parts_may_differ(spark, tmp_path):
    """A vintage has the columns of all its parts in the type that holds all, whatever their order."""
    parts = {
        "a": ([("x", 1, 1)], "caudef string, edadif int, sexo int"),
        "b": ([("y", 2.5, "2", "norte")], "caudef string, edadif double, sexo string, areag string"),
        "c": ([("z", 3, 1, "p")], "caudef string, edadif bigint, sexo int, perdif string"),
        "d": ([("w", 4, 1, "q")], "caudef string, edadif bigint, sexo int, perdif string"),
    }
    for i, order in enumerate(("abcd", "dcba", "bdac")):
        folder = tmp_path / f"201{i}-d.parquet"
        for n, part in enumerate(order):
            staged = tmp_path / f"{i}{part}"
            spark.createDataFrame(*parts[part]).coalesce(1).write.parquet(str(staged))
            folder.mkdir(exist_ok=True)
            (folder / f"part-{n}.parquet").write_bytes(next(staged.glob("part-*.parquet")).read_bytes())
        df = landing.read_vintage(spark, str(folder))
        assert dict(df.dtypes) == {"caudef": "string", "edadif": "double", "sexo": "string", "areag": "string", "perdif": "string"}
        assert rows(df, "caudef", "edadif", "sexo", "areag", "perdif") == [
            ("w", 4.0, "1", None, "q"), ("x", 1.0, "1", None, None), ("y", 2.5, "2", "norte", None), ("z", 3.0, "1", None, "p"),
        ]
    raw = str(tmp_path)
    spark.createDataFrame([("u", 1)], "caudef string, x int").coalesce(1).write.parquet(f"{raw}/none/2010-x.parquet")
    found = {r["filename"]: (r["dataset_type"], r["nrows"]) for r in landing.scan(spark, raw).where("filename LIKE '201%d.parquet'").collect()}
    assert found == {f"201{i}-d.parquet": ("defunciones", 4) for i in range(3)}
    labels = {"2010-d.parquet": {"sexo": {1.0: "Masculino", 2: "Femenino"}}}
    etl.run_load(spark, raw, f"{raw}/out", "defunciones", labels)
    loaded = curated.read_curated(spark, f"{raw}/out", "defunciones").where("_year = 2010")
    assert rows(loaded, "caudef", "sexo", "areag") == [("W", "Hombre", None), ("X", "Hombre", None), ("Y", "Mujer", "Norte"), ("Z", "Hombre", None)]


def test_csv_parts_by_header(spark, tmp_path):
    folder = tmp_path / "2020-w.csv"
    folder.mkdir()
    (folder / "a.csv").write_text("clauni,edadhom\nx,20\n")
    (folder / "b.csv").write_text("edadhom,edadmuj,clauni\n30,31,y\n")
    assert rows(landing.read_vintage(spark, str(folder)), "clauni", "edadhom", "edadmuj") == [("x", "20", None), ("y", "30", "31")]


@pytest.mark.parametrize(
    "a, b, want",
    [("int", "bigint", "bigint"), ("float", "int", "double"), ("decimal(9,2)", "double", "double"), ("date", "timestamp", "timestamp"),
     ("date", "timestamp_ntz", "timestamp_ntz"), ("int", "string", "string"), ("boolean", "int", "string"), ("date", "int", "string")],
)
def test_type_lattice(a, b, want):
    assert landing.wider_type(a, b) == landing.wider_type(b, a) == want


def test_the_status_counts_what_is_lost(spark, tmp_path):
    """Texts in numeric columns and differing former names are counted by the write itself."""
    data = [("1", "u", 2010.0, 2010.0), ("viejo", "v", 2010.0, 2011.0), (" ", "w", None, 2012.0), (None, "x", 2010.0, None)]
    frame = spark.createDataFrame(data, "edadif string, caudef string, anioreg double, `añoreg` double")
    frame.withColumns({"sexo": F.lit("f"), "perdif": F.lit("p")}).coalesce(1).write.parquet(f"{tmp_path}/raw/2012-d.parquet")
    result = etl.run_load(spark, f"{tmp_path}/raw", f"{tmp_path}/out")
    row = result.status.first()
    assert (row["nrows"], row["lost"], row["clashes"]) == (4, {"edadif": 1}, {"anioreg": 1})
    assert result.clashes == {"2012-d.parquet": {"anioreg": ["anioreg", "añoreg"]}}
