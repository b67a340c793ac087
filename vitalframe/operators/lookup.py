"""Dictionary lookups by code: numbers and their texts are one code, whatever the column's type."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalframe.sources.scratch import materialise

#: A dictionary of more bytes than this is not broadcast.
BROADCAST_BYTES = 32 << 20
#: A code that more than one in so many rows has is hot; there are at most as many.
HOT_SHARE = 4096
#: What an entry takes besides its texts.
_ENTRY = 64

LOOKUP_SCHEMA = "_code string, _value string"


def code_of(col: Column, kind: str) -> Column:
    """A value as code: a number's text where it is one (``1``, ``1.0`` and ``'01'`` agree), else its text."""
    if kind == "string":
        number = F.trim(col).try_cast("double").cast("string")
        return F.coalesce(number, col)
    if kind in ("boolean", "date", "timestamp", "timestamp_ntz", "binary"):
        return col.cast("string")
    return col.cast("double").cast("string")


def split_codes(pairs: Mapping[object, str]) -> tuple[dict[float, str], dict[str, str]]:
    """Labels by number, and those of codes that are no numbers by text; of equal codes the last counts."""
    numbers: dict[float, str] = {}
    texts: dict[str, str] = {}
    for code, label in pairs.items():
        try:
            number = float(code)  # type: ignore[arg-type]
        except (TypeError, ValueError):
            number = math.nan
        if math.isfinite(number):
            numbers[number + 0.0] = str(label)
        else:
            texts[str(code)] = str(label)
    return numbers, texts


def frame_of(spark: SparkSession, pairs: Mapping[object, str]) -> DataFrame:
    """A Python dictionary as lookup table ``(_code, _value)``, a row per code."""
    numbers, texts = split_codes(pairs)
    rows = [(repr(k), v) for k, v in numbers.items()] + list(texts.items())
    raw = spark.createDataFrame(rows, LOOKUP_SCHEMA)
    return raw.select(code_of(F.col("_code"), "string").alias("_code"), "_value")


def lookup_of(dictionary: DataFrame) -> DataFrame:
    """A table ``(key, value)`` as lookup table; of several values of a code the smallest counts."""
    code = code_of(F.col("key"), dict(dictionary.dtypes)["key"])
    return dictionary.where(F.col("key").isNotNull()).groupBy(code.alias("_code")).agg(F.min(F.col("value").cast("string")).alias("_value"))


def lookup_bytes(lookup: DataFrame) -> int:
    """Size of a lookup table in memory, counted in one job."""
    size = F.octet_length("_code") + F.octet_length(F.coalesce("_value", F.lit(""))) + _ENTRY
    return lookup.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]


def join_lookup(df: DataFrame, code: Column, lookup: DataFrame, out: str, size: int | None = None, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with the code's value as column ``out``, NULL where it has none. No row is lost or multiplied.

    ``size`` is the lookup table's, counted if not given. Up to ``limit`` bytes it is broadcast. A larger one is joined by
    shuffle, but the codes that many rows have, which can't be many, and the rows without a code stay out of that.
    """
    named = lookup.select(F.col("_code"), F.col("_value").alias(out))
    coded = df.withColumn("_probe", code)
    if (lookup_bytes(lookup) if size is None else size) <= limit:
        return coded.join(F.broadcast(named), coded["_probe"] == named["_code"], "left").select(*_columns(df), out)
    counts = materialise(coded.where("_probe IS NOT NULL").groupBy("_probe").agg(F.count("*").alias("_n")), "codes")
    least = (counts.agg(F.sum("_n")).first()[0] or 0) // HOT_SHARE
    hot = counts.where(F.col("_n") > least).join(named, F.col("_probe") == F.col("_code"), "left").select(F.col("_probe").alias("_hot"), out)
    marked = coded.join(F.broadcast(hot), F.col("_probe") == F.col("_hot"), "left")
    settled = marked.where("_hot IS NOT NULL OR _probe IS NULL").select(*_columns(df), out)
    rest = marked.where("_hot IS NULL AND _probe IS NOT NULL").drop(out)
    return settled.unionByName(rest.join(named, F.col("_probe") == F.col("_code"), "left").select(*_columns(df), out))


def _columns(df: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in df.columns]
