"""Value labels, numeric coercion and dictionary lookups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalframe.functions.text import literal_map
from vitalframe.operators import lookup
from vitalframe.sources.scratch import materialise

# Dictionaries above this many entries are joined instead of inlined into the plan; results are the same.
INLINE_LIMIT = 1_000

Labels = Mapping[str, Mapping[object, str]]


def _labels_for(df: DataFrame, labels: Labels) -> dict[str, Mapping[object, str]]:
    """Labels by actual column name; names match without regard to case."""
    known = {name.lower(): pairs for name, pairs in labels.items() if pairs}
    return {c: known[c.lower()] for c in df.columns if c.lower() in known}


def _label(col: Column, pairs: Mapping[object, str], kind: str) -> Column:
    """A code's label, inlined; NULL without one. Numbers match as numbers in text columns too."""
    numbers, texts = lookup.split_codes(pairs)
    found = []
    if numbers:
        number = F.trim(col).try_cast("double") if kind == "string" else col.cast("double")
        found.append(F.try_element_at(literal_map(numbers), number))
    if texts and kind == "string":
        found.append(F.try_element_at(literal_map(texts), col))
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def with_labels(df: DataFrame, found: Mapping[str, Mapping[object, str]]) -> tuple[DataFrame, dict[str, Column]]:
    """The frame, and for every labelled column the expression of its label.

    Dictionaries of more than ``INLINE_LIMIT`` entries would make the plan too long, so they are joined and
    their labels are further columns.
    """
    types = dict(df.dtypes)
    labels: dict[str, Column] = {}
    for i, (c, pairs) in enumerate(found.items()):
        if len(pairs) <= INLINE_LIMIT:
            labels[c] = _label(F.col(f"`{c}`"), pairs, types[c])
            continue
        table = lookup.frame_of(df.sparkSession, pairs)
        size = sum(len(str(k)) + len(str(v).encode()) + 64 for k, v in pairs.items())
        df = lookup.join_lookup(df, lookup.code_of(F.col(f"`{c}`"), types[c]), table, f"_label_{i}", size)
        labels[c] = F.col(f"_label_{i}")
    return df, labels


def _valid(c: str, kind: str) -> Column:
    """The value, NULL if it is missing; NaN is."""
    col = F.col(f"`{c}`")
    return F.when(~F.isnan(col), col) if kind in ("double", "float") else col


def label_ratio(df: DataFrame, labels: Labels) -> DataFrame:
    """``(column, n_valid, n_labelled, ratio)`` for all labelled columns in one pass; NaN is no valid value."""
    types = dict(df.dtypes)
    found = _labels_for(df, labels)
    if not found:
        schema = "column string, n_valid bigint, n_labelled bigint, ratio double"
        return df.sparkSession.createDataFrame([], schema)
    labelled, label = with_labels(df, found)
    one_pass = labelled.agg(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.count(_valid(c, types[c])).alias("n_valid"),
                F.count(label[c]).alias("n_labelled"),
            ).alias(f"_c{i}")
            for i, c in enumerate(found)
        ]
    )
    rows = one_pass.select(F.inline(F.array(*[f"_c{i}" for i in range(len(found))])))
    ratio = F.when(F.col("n_valid") > 0, F.col("n_labelled") / F.col("n_valid"))
    return rows.withColumn("ratio", ratio)


def decode_categorical(col: Column, pairs: Mapping[object, str], kind: str) -> Column:
    """Code to label; unlabelled values stay as text."""
    return F.coalesce(_label(col, pairs, kind), col.cast("string"))


def null_sentinels(col: Column, pairs: Mapping[object, str], kind: str) -> Column:
    """Codes listed in the dictionary become NULL."""
    return F.when(_label(col, pairs, kind).isNull(), col)


def decode_with_ratios(df: DataFrame, labels: Labels, ratios: Mapping[str, float]) -> DataFrame:
    """Apply labels given the labelled ratio of each column; one projection.

    Columns absent from ``ratios`` (all NULL, or no labels) are left as they are.
    """
    found = {c: p for c, p in _labels_for(df, labels).items() if ratios.get(c) is not None}
    labelled, label = with_labels(df, found)

    def project(c: str) -> Column:
        col = F.col(f"`{c}`")
        if c not in found:
            return col
        decoded = F.coalesce(label[c], col.cast("string")) if ratios[c] > 0.5 else F.when(label[c].isNull(), col)
        return decoded.alias(c)

    return labelled.select(*[project(c) for c in df.columns])


def replace_by_join(df: DataFrame, col: str, dictionary: DataFrame, limit: int = lookup.BROADCAST_BYTES) -> DataFrame:
    """Dictionary lookup as a left join on ``dictionary(key, value)``; unmatched values stay, as text.

    Repeated keys are reduced to one row first so that the join never multiplies rows. A dictionary of up to
    ``limit`` bytes is broadcast, a larger one shuffled beside its hot codes.
    """
    table = materialise(lookup.lookup_of(dictionary), "lookup")
    source = F.col(f"`{col}`")
    joined = lookup.join_lookup(df, lookup.code_of(source, dict(df.dtypes)[col]), table, "_value_of", limit=limit)
    return joined.select(
        *[F.coalesce("_value_of", source.cast("string")).alias(c) if c == col else F.col(f"`{c}`") for c in df.columns]
    )


def apply_labels(df: DataFrame, labels: Labels) -> DataFrame:
    """Decode a vintage: one aggregate for the ratios (a row per labelled column), one projection."""
    ratios = {r["column"]: r["ratio"] for r in label_ratio(df, labels).collect()}
    return decode_with_ratios(df, labels, ratios)


def numeric_shares(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``(column, n_valid, n_numeric, share)`` for the text columns, in one pass."""
    text = [c for c, t in df.dtypes if t == "string" and (cols is None or c in cols)]
    one_pass = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.count(c).alias("n_valid"),
                F.count(F.col(c).try_cast("double")).alias("n_numeric"),
            ).alias(f"_c{i}")
            for i, c in enumerate(text)
        ]
    )
    rows = one_pass.select(F.inline(F.array(*[f"_c{i}" for i in range(len(text))])))
    share = F.when(F.col("n_valid") > 0, F.col("n_numeric") / F.col("n_valid"))
    return rows.withColumn("share", share)


def coerce_numeric(
    df: DataFrame, cols: Sequence[str] | None = None, min_share: float = 0.8
) -> DataFrame:
    """Turn a text column into double when more than ``min_share`` of its values parse."""
    text = [c for c, t in df.dtypes if t == "string" and (cols is None or c in cols)]
    if not text:
        return df
    shares = numeric_shares(df, text).where(F.col("share") > min_share).collect()
    chosen = {r["column"] for r in shares}
    return df.select(
        *[F.col(c).try_cast("double").alias(c) if c in chosen else F.col(c) for c in df.columns]
    )


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN becomes NULL in every floating-point column."""
    return df.select(
        *[
            F.when(~F.isnan(f"`{c}`"), F.col(f"`{c}`")).alias(c) if t in ("double", "float") else F.col(f"`{c}`")
            for c, t in df.dtypes
        ]
    )
