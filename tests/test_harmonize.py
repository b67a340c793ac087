import pytest
from helpers import rows
from pyspark.sql import functions as F

from vitalframe import specs
from vitalframe.functions import text
from vitalframe.operators.harmonize import alias_clashes, harmonize, union_vintages


def test_column_counts():
    sizes = {d: len(specs.columns(d)) for d in specs.datasets()}
    assert sizes == {
        "nacimientos": 44,
        "defunciones": 28,
        "defunciones_fetales": 31,
        "matrimonios": 23,
        "divorcios": 19,
    }


def test_schema_metadata():
    field = specs.canonical_schema("defunciones")["puedif"]
    assert field.metadata == {"description": "Pueblo de pertenencia del difunto", "aliases": ["getdif"]}


@pytest.mark.parametrize(
    "raw,title",
    [
        ("casado(a)", "Casado(A)"),
        ("1 año y má", "1 Año Y Má"),
        ("médico/año 1er", "Médico/Año 1er"),
        ("mestizo / ladino", "Mestizo / Ladino"),
        ("ÁREA-URBANA", "Área-Urbana"),
        ("x\u0001 y", "X\u0001 Y"),
        ("", ""),
        (None, None),
    ],
)
def test_title_case(spark, raw, title):
    df = spark.createDataFrame([(raw,)], "t string")
    assert df.select(text.title_case(F.col("t"))).first()[0] == title


def test_dictionary_keys_are_title_cased(spark):
    keys = [(k,) for d in specs.value_dictionaries().values() for k in d]
    df = spark.createDataFrame(keys, "k string")
    assert df.where(text.title_case(F.col("k")) != F.col("k")).count() == 0


def test_strip_takes_all_white_space(spark):
    df = spark.createDataFrame([("\t\u00a0 a b \u3000\n",), ("   ",)], "t string")
    assert [r[0] for r in df.select(text.strip(F.col("t"))).collect()] == ["a b", ""]


def test_short_label_and_slug(spark):
    df = spark.createDataFrame([("Edad del difunto Nota: en años",), ("x" * 50,)], "t string")
    out = [r[0] for r in df.select(text.short_label(F.col("t"))).collect()]
    assert out == ["Edad del difunto", "x" * 37 + "..."]
    slug = spark.createDataFrame([("  Año de\tRegistro (1) ",)], "t string")
    assert slug.select(text.slug(F.col("t"))).first()[0] == "ao_de_registro_1"


@pytest.fixture()
def vintages(spark):
    old = spark.createDataFrame(
        [(" MASCULINO ", "mestizo / ladino", "casado(a)", "QUICHE", "x")],
        "SEXO string, GETDIF string, ECIDIF string, DEPOCU string, `caudef.descrip` string",
    )
    middle = spark.createDataFrame(
        [("Femenino", "xinca", "Soltero(a)", 320.0)],
        "sexo string, puedif string, ecidif string, predif double",
    )
    new = spark.createDataFrame(
        [("Hombre", "Garífuna", "Rural", 1)], "sexo string, puedif string, areag string, extra int"
    )
    return [
        harmonize(df, "defunciones", y, f"{y}.parquet")
        for df, y in ((old, 2012), (middle, 2015), (new, 2020))
    ]


def test_vintages_share_one_schema(vintages):
    expected = [f.simpleString() for f in specs.canonical_schema("defunciones")]
    for df in vintages:
        assert [f.simpleString() for f in df.schema] == expected


def test_values_after_harmonising(vintages):
    out = union_vintages(vintages)
    assert rows(out, "_year", "sexo", "puedif", "ecidif", "depocu", "predif", "areag") == [
        (2012, "Hombre", "Ladino/Mestizo", "Casado", "Quiché", None, None),
        (2015, "Mujer", "Xinka", "Soltero", None, "Guatemala", None),
        (2020, "Hombre", "Garifuna", None, None, None, "Rural"),
    ]


def test_harmonising_twice_changes_nothing(vintages):
    once = union_vintages(vintages)
    again = harmonize(once, "defunciones", F.col("_year"), F.col("_source_file"))
    assert rows(again) == rows(once)


def test_clash_prefers_canonical(spark):
    df = spark.createDataFrame(
        [("maya", "xinca"), (None, "xinca")], "PUEDIF string, getdif string"
    )
    assert alias_clashes(df, "defunciones") == {"puedif": ["puedif", "getdif"]}
    out = harmonize(df, "defunciones", None, "f")
    assert rows(out, "puedif") == [("Maya",), ("Xinka",)]
    assert out.first()["_year"] is None


def test_text_in_a_numeric_column_becomes_null(spark):
    df = spark.createDataFrame([("34",), ("ignorado",)], "edadif string")
    assert rows(harmonize(df, "defunciones", 2020, "f"), "edadif") == [(None,), (34.0,)]
