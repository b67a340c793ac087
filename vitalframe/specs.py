"""Declared knowledge about the five registry datasets.

Everything here is data: canonical column lists with types, former names and descriptions, the
column signatures that identify a file, and the spelling dictionaries applied while harmonising.
Helpers turn that data into Spark schemas, config DataFrames and dictionaries.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

UNKNOWN_DATASET = "desconocido"
ERROR_DATASET = "error"
NOISE_COLUMNS = ("caudef.descrip",)
YEAR_RANGE = (2009, 2030)

@dataclass(frozen=True)
class ColumnSpec:
    name: str
    type: str
    aliases: tuple[str, ...]
    description: str


# Canonical columns in canonical order: name, type, former names, description.
_COLUMNS: dict[str, tuple[ColumnSpec, ...]] = {
    "nacimientos": (
        ColumnSpec("depreg", "string", (), "Departamento de registro"),
        ColumnSpec("mupreg", "string", (), "Municipio de registro"),
        ColumnSpec("mesreg", "string", (), "Mes de registro"),
        ColumnSpec("anioreg", "double", ("añoreg",), "Año de registro"),
        ColumnSpec("tipoins", "string", (), "Tipo de inscripción"),
        ColumnSpec("depocu", "string", (), "Departamento de ocurrencia"),
        ColumnSpec("mupocu", "string", (), "Municipio de ocurrencia"),
        ColumnSpec("libras", "double", (), "Peso en libras"),
        ColumnSpec("onzas", "double", (), "Peso en onzas"),
        ColumnSpec("diaocu", "double", (), "Día de ocurrencia"),
        ColumnSpec("mesocu", "string", (), "Mes de ocurrencia"),
        ColumnSpec("anioocu", "double", ("añoocu",), "Año de ocurrencia"),
        ColumnSpec("sexo", "string", (), "Sexo del nacido"),
        ColumnSpec("tipar", "string", (), "Tipo de parto"),
        ColumnSpec("viapar", "string", (), "Vía del parto"),
        ColumnSpec("edadp", "double", (), "Edad del padre"),
        ColumnSpec("paisrep", "string", (), "País de residencia del padre"),
        ColumnSpec("deprep", "string", (), "Departamento de residencia del padre"),
        ColumnSpec("muprep", "string", (), "Municipio de residencia del padre"),
        ColumnSpec("pueblopp", "string", ("gretnp",), "Pueblo de pertenencia del padre"),
        ColumnSpec("escivp", "string", (), "Estado civil del padre"),
        ColumnSpec("paisnacp", "string", (), "País de nacimiento del padre"),
        ColumnSpec("depnap", "string", (), "Departamento de nacimiento del padre"),
        ColumnSpec("munpnap", "string", ("mupnap",), "Municipio de nacimiento del padre"),
        ColumnSpec("naciop", "string", (), "Nacionalidad del padre"),
        ColumnSpec("escolap", "string", (), "Escolaridad del padre"),
        ColumnSpec("ocupap", "string", ("ciuopad",), "Ocupación del padre"),
        ColumnSpec("edadm", "double", (), "Edad de la madre"),
        ColumnSpec("paisrem", "string", (), "País de residencia de la madre"),
        ColumnSpec("deprem", "string", (), "Departamento de residencia de la madre"),
        ColumnSpec("muprem", "string", (), "Municipio de residencia de la madre"),
        ColumnSpec("pueblopm", "string", ("grupetma",), "Pueblo de pertenencia de la madre"),
        ColumnSpec("escivm", "string", (), "Estado civil de la madre"),
        ColumnSpec("paisnacm", "string", (), "País de nacimiento de la madre"),
        ColumnSpec("depnam", "string", (), "Departamento de nacimiento de la madre"),
        ColumnSpec("mupnam", "string", ("munnam",), "Municipio de nacimiento de la madre"),
        ColumnSpec("naciom", "string", (), "Nacionalidad de la madre"),
        ColumnSpec("escolam", "string", (), "Escolaridad de la madre"),
        ColumnSpec("ocupam", "string", ("ciuomad",), "Ocupación de la madre"),
        ColumnSpec("asisrec", "string", (), "Asistencia recibida"),
        ColumnSpec("sitioocu", "string", (), "Sitio de ocurrencia"),
        ColumnSpec("tohite", "double", (), "Total hijos tenidos"),
        ColumnSpec("tohinm", "double", (), "Total hijos nacidos muertos"),
        ColumnSpec("tohivi", "double", (), "Total hijos vivos"),
    ),
    "defunciones": (
        ColumnSpec("depreg", "string", (), "Departamento de registro"),
        ColumnSpec("mupreg", "string", (), "Municipio de registro"),
        ColumnSpec("mesreg", "string", (), "Mes de registro"),
        ColumnSpec("anioreg", "double", ("añoreg",), "Año de registro"),
        ColumnSpec("depocu", "string", (), "Departamento de ocurrencia"),
        ColumnSpec("mupocu", "string", (), "Municipio de ocurrencia"),
        ColumnSpec("areag", "string", (), "Área geográfica"),
        ColumnSpec("sexo", "string", (), "Sexo del difunto"),
        ColumnSpec("diaocu", "double", (), "Día de ocurrencia"),
        ColumnSpec("mesocu", "string", (), "Mes de ocurrencia"),
        ColumnSpec("anioocu", "double", ("añoocu",), "Año de ocurrencia"),
        ColumnSpec("edadif", "double", (), "Edad del difunto"),
        ColumnSpec("perdif", "string", (), "Período de edad del difunto"),
        ColumnSpec("puedif", "string", ("getdif",), "Pueblo de pertenencia del difunto"),
        ColumnSpec("ecidif", "string", (), "Estado civil del difunto"),
        ColumnSpec("escodif", "string", (), "Escolaridad del difunto"),
        ColumnSpec("ciuodif", "string", ("ocudif",), "Ocupación del difunto"),
        ColumnSpec("pnadif", "string", (), "País de nacimiento del difunto"),
        ColumnSpec("dnadif", "string", (), "Departamento de nacimiento del difunto"),
        ColumnSpec("mnadif", "string", (), "Municipio de nacimiento del difunto"),
        ColumnSpec("nacdif", "string", (), "Nacionalidad del difunto"),
        ColumnSpec("predif", "string", (), "País de residencia del difunto"),
        ColumnSpec("dredif", "string", (), "Departamento de residencia del difunto"),
        ColumnSpec("mredif", "string", (), "Municipio de residencia del difunto"),
        ColumnSpec("caudef", "string", (), "Causa de defunción"),
        ColumnSpec("asist", "string", (), "Asistencia médica"),
        ColumnSpec("ocur", "string", (), "Lugar de ocurrencia"),
        ColumnSpec("cerdef", "string", (), "Certificado de defunción"),
    ),
    "defunciones_fetales": (
        ColumnSpec("depreg", "string", (), "Departamento de registro"),
        ColumnSpec("mupreg", "string", (), "Municipio de registro"),
        ColumnSpec("mesreg", "string", (), "Mes de registro"),
        ColumnSpec("anioreg", "double", ("añoreg",), "Año de registro"),
        ColumnSpec("depocu", "string", (), "Departamento de ocurrencia"),
        ColumnSpec("mupocu", "string", (), "Municipio de ocurrencia"),
        ColumnSpec("areag", "string", (), "Área geográfica"),
        ColumnSpec("sexo", "string", (), "Sexo"),
        ColumnSpec("diaocu", "double", (), "Día de ocurrencia"),
        ColumnSpec("mesocu", "string", (), "Mes de ocurrencia"),
        ColumnSpec("anioocu", "double", ("añoocu",), "Año de ocurrencia"),
        ColumnSpec("tipar", "string", (), "Tipo de parto"),
        ColumnSpec("clapar", "string", (), "Clase de parto"),
        ColumnSpec("viapar", "string", (), "Vía del parto"),
        ColumnSpec("semges", "double", (), "Semanas de gestación"),
        ColumnSpec("edadm", "double", (), "Edad de la madre"),
        ColumnSpec("paisrem", "string", (), "País de residencia de la madre"),
        ColumnSpec("deprem", "string", (), "Departamento de residencia de la madre"),
        ColumnSpec("muprem", "string", (), "Municipio de residencia de la madre"),
        ColumnSpec("pueblopm", "string", ("gretnm",), "Pueblo de pertenencia de la madre"),
        ColumnSpec("escivm", "string", (), "Estado civil de la madre"),
        ColumnSpec("nacionm", "string", ("naciom",), "Nacionalidad de la madre"),
        ColumnSpec("escolam", "string", (), "Escolaridad de la madre"),
        ColumnSpec("ocupam", "string", (), "Ocupación de la madre"),
        ColumnSpec("ciuomad", "string", (), "Ocupación de la madre (alt)"),
        ColumnSpec("caudef", "string", (), "Causa de defunción"),
        ColumnSpec("asisrec", "string", (), "Asistencia recibida"),
        ColumnSpec("sitioocu", "string", (), "Sitio de ocurrencia"),
        ColumnSpec("tohite", "double", (), "Total hijos tenidos"),
        ColumnSpec("tohinm", "double", (), "Total hijos nacidos muertos"),
        ColumnSpec("tohivi", "double", (), "Total hijos vivos"),
    ),
    "matrimonios": (
        ColumnSpec("depreg", "string", (), "Departamento de registro"),
        ColumnSpec("mupreg", "string", (), "Municipio de registro"),
        ColumnSpec("mesreg", "string", (), "Mes de registro"),
        ColumnSpec("anioreg", "double", ("añoreg",), "Año de registro"),
        ColumnSpec("anioocu", "double", ("añoocu",), "Año de ocurrencia"),
        ColumnSpec("clauni", "string", (), "Clase de unión"),
        ColumnSpec("nunuho", "double", (), "Número de nupcias del hombre"),
        ColumnSpec("nunumu", "double", (), "Número de nupcias de la mujer"),
        ColumnSpec("edadhom", "double", (), "Edad del hombre"),
        ColumnSpec("edadmuj", "double", (), "Edad de la mujer"),
        ColumnSpec("puehom", "string", ("gethom",), "Pueblo de pertenencia del hombre"),
        ColumnSpec("puemuj", "string", ("getmuj",), "Pueblo de pertenencia de la mujer"),
        ColumnSpec("nachom", "string", (), "Nacionalidad del hombre"),
        ColumnSpec("nacmuj", "string", (), "Nacionalidad de la mujer"),
        ColumnSpec("eschom", "string", (), "Escolaridad del hombre"),
        ColumnSpec("escmuj", "string", (), "Escolaridad de la mujer"),
        ColumnSpec("ciuohom", "string", ("ocuhom",), "Ocupación del hombre"),
        ColumnSpec("ciuomuj", "string", ("ocumuj",), "Ocupación de la mujer"),
        ColumnSpec("depocu", "string", (), "Departamento de ocurrencia"),
        ColumnSpec("mupocu", "string", (), "Municipio de ocurrencia"),
        ColumnSpec("diaocu", "double", (), "Día de ocurrencia"),
        ColumnSpec("mesocu", "string", (), "Mes de ocurrencia"),
        ColumnSpec("areagocu", "string", ("areag",), "Área geográfica de ocurrencia"),
    ),
    "divorcios": (
        ColumnSpec("depreg", "string", (), "Departamento de registro"),
        ColumnSpec("mupreg", "string", (), "Municipio de registro"),
        ColumnSpec("mesreg", "string", (), "Mes de registro"),
        ColumnSpec("anioreg", "double", ("añoreg",), "Año de registro"),
        ColumnSpec("diaocu", "double", (), "Día de ocurrencia"),
        ColumnSpec("mesocu", "string", (), "Mes de ocurrencia"),
        ColumnSpec("anioocu", "double", ("añoocu",), "Año de ocurrencia"),
        ColumnSpec("depocu", "string", (), "Departamento de ocurrencia"),
        ColumnSpec("mupocu", "string", (), "Municipio de ocurrencia"),
        ColumnSpec("edadhom", "double", (), "Edad del hombre"),
        ColumnSpec("edadmuj", "double", (), "Edad de la mujer"),
        ColumnSpec("puehom", "string", ("pperhom", "gethom"), "Pueblo de pertenencia del hombre"),
        ColumnSpec("puemuj", "string", ("ppermuj", "getmuj"), "Pueblo de pertenencia de la mujer"),
        ColumnSpec("nachom", "string", (), "Nacionalidad del hombre"),
        ColumnSpec("nacmuj", "string", (), "Nacionalidad de la mujer"),
        ColumnSpec("eschom", "string", (), "Escolaridad del hombre"),
        ColumnSpec("escmuj", "string", (), "Escolaridad de la mujer"),
        ColumnSpec("ciuohom", "string", ("ocuhom",), "Ocupación del hombre"),
        ColumnSpec("ciuomuj", "string", ("ocumuj",), "Ocupación de la mujer"),
    ),
}

# Column signatures, in the order in which datasets are tried.
SIGNATURES = (
    ("nacimientos", ("libras", "onzas", "sexo", "tipar")),
    ("nacimientos", ("libras", "onzas", "sexo", "naciop")),
    ("nacimientos", ("libras", "onzas", "sexo", "edadp", "edadm")),
    ("defunciones", ("caudef", "edadif", "sexo", "perdif")),
    ("defunciones_fetales", ("semges", "caudef", "tipar", "edadm")),
    ("matrimonios", ("clauni", "edadhom", "edadmuj")),
    ("divorcios", ("edadhom", "edadmuj", "ciuohom", "ciuomuj")),
    ("divorcios", ("edadhom", "edadmuj", "ocuhom", "ocumuj")),
)

# Numeric country codes.
_COUNTRIES = {
    "320": "Guatemala",
    "222": "El Salvador",
    "340": "Honduras",
    "484": "México",
    "840": "Estados Unidos De América",
    "84": "Belice",
    "170": "Colombia",
    "188": "Costa Rica",
    "192": "Cuba",
    "276": "Alemania",
    "380": "Italia",
    "156": "China",
    "410": "República De Corea",
    "124": "Canadá",
    "604": "Perú",
    "724": "España",
    "862": "Venezuela",
    "558": "Nicaragua",
    "076": "Brasil",
    "858": "Uruguay",
    "032": "Argentina",
    "152": "Chile",
    "218": "Ecuador",
    "591": "Panamá",
    "214": "República Dominicana",
    "332": "Haití",
    "388": "Jamaica",
    "826": "Gran Bretaña",
    "250": "Francia",
    "392": "Japón",
    "356": "India",
    "643": "Rusia",
    "458": "Malasia",
    "720": "Yemen",
    "721": "El Salvador",
    "723": "El Salvador",
    "275": "Palestina",
    "642": "Rumania",
    "40": "Austria",
    "1020": "Ignorado",
    "1026": "Ignorado",
    "1045": "Ignorado",
    "9999": "Ignorado",
}

# Spelling variants per column, written as they look after title-casing.
_SPELLINGS = {
    "dnadif": {"Quiche": "Quiché", "9999.0": "Ignorado", "9999": "Ignorado"},
    "depocu": {"Quiche": "Quiché"},
    "depreg": {"Quiche": "Quiché"},
    "ecidif": {
        "Casado(A)": "Casado",
        "Soltero(A)": "Soltero",
        "Divorciado(A)": "Divorciado",
        "Viudo(A)": "Viudo",
        "Unido(A)": "Unido",
        "Separado(A)": "Separado",
    },
    "puedif": {
        "Mestizo, Ladino": "Ladino/Mestizo",
        "Mestizo / Ladino": "Ladino/Mestizo",
        "Mestizo/Ladino": "Ladino/Mestizo",
        "No Indigena": "No Indígena",
        "Indigena": "Indígena",
        "Garífuna": "Garifuna",
        "Xinca": "Xinka",
    },
    "perdif": {"1 Año Y Má": "1 Año Y Más"},
    "cerdef": {"Medico": "Médico", "Paramedico": "Paramédico"},
    "sexo": {"Masculino": "Hombre", "Femenino": "Mujer"},
}
_COUNTRY_COLUMNS = ("predif", "pnadif", "paisrem", "paisrep", "paisnacp", "paisnacm")


def columns(dataset: str) -> tuple[ColumnSpec, ...]:
    """Canonical columns of ``dataset`` in canonical order; empty for an unknown name."""
    return _COLUMNS.get(dataset, ())


def datasets() -> list[str]:
    return list(_COLUMNS)


def column_descriptions(dataset: str) -> dict[str, str]:
    return {c.name: c.description for c in columns(dataset)}


def canonical_schema(dataset: str, lineage: bool = True) -> T.StructType:
    """Spark schema of the harmonised table; descriptions and former names ride in metadata."""
    kinds = {"string": T.StringType(), "double": T.DoubleType()}
    fields = [
        T.StructField(
            c.name,
            kinds[c.type],
            True,
            {"description": c.description, "aliases": list(c.aliases)},
        )
        for c in columns(dataset)
    ]
    if lineage:
        fields.append(T.StructField("_year", T.ShortType(), True))
        fields.append(T.StructField("_source_file", T.StringType(), True))
    return T.StructType(fields)


@lru_cache(maxsize=None)
def country_names() -> dict[str, str]:
    """Country code text, with and without a trailing ``.0`` -> name."""
    return {text: name for code, name in _COUNTRIES.items() for text in (f"{code}.0", code)}


def value_dictionaries() -> dict[str, dict[str, str]]:
    """Column name -> {title-cased text: canonical text}; shared by all datasets."""
    return {**_SPELLINGS, **{c: country_names() for c in _COUNTRY_COLUMNS}}


def description_frame(spark: SparkSession, dataset: str) -> DataFrame:
    """Metadata table ``(column, description)`` of one dataset."""
    return spark.createDataFrame(
        list(column_descriptions(dataset).items()), "column string, description string"
    )
