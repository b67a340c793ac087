"""Bring one vintage of a registry dataset to its canonical shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalframe import specs
from vitalframe.functions.text import replace_values, strip, title_case


def lower_names(df: DataFrame) -> DataFrame:
    """Lower-case every column name."""
    return df.toDF(*[c.lower() for c in df.columns])


def drop_noise(df: DataFrame) -> DataFrame:
    """Drop columns known to carry nothing of use."""
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in specs.NOISE_COLUMNS])


def sources_of(dataset: str, names: list[str]) -> dict[str, list[str]]:
    """Canonical name -> columns of the file that feed it, canonical name first."""
    present = set(names)
    return {
        c.name: [n for n in (c.name, *c.aliases) if n in present] for c in specs.columns(dataset)
    }


def alias_clashes(df: DataFrame, dataset: str) -> dict[str, list[str]]:
    """Canonical columns fed by more than one column of the file."""
    found = sources_of(dataset, [c.lower() for c in df.columns])
    return {name: cols for name, cols in found.items() if len(cols) > 1}


def clean_value(value: Column, name: str, source_type: str, target_type: str) -> Column:
    """Trim and title-case text, apply the column's dictionary, cast to the canonical type."""
    if source_type == "string":
        value = title_case(strip(value))
    pairs = specs.value_dictionaries().get(name)
    if pairs:
        value = replace_values(value.cast("string"), pairs)
    return value.try_cast(target_type)


def harmonize(
    df: DataFrame,
    dataset: str,
    year: int | Column | None,
    source_file: str | Column | None,
) -> DataFrame:
    """Canonical columns in canonical order plus ``_year`` and ``_source_file``.

    The whole step is one projection. A file that holds both a canonical column and one of its
    former names keeps the canonical value and falls back to the others in listed order.
    """
    lowered = drop_noise(lower_names(df))
    types = dict(lowered.dtypes)
    found = sources_of(dataset, lowered.columns)
    projected = []
    for spec in specs.columns(dataset):
        parts = [
            clean_value(F.col(f"`{c}`"), spec.name, types[c], spec.type) for c in found[spec.name]
        ]
        if not parts:
            projected.append(F.expr(f"CAST(NULL AS {spec.type}) AS {spec.name}"))
            continue
        value = F.coalesce(*parts) if len(parts) > 1 else parts[0]
        projected.append(value.alias(spec.name))
    year = year if isinstance(year, Column) else F.lit(year)
    source = source_file if isinstance(source_file, Column) else F.lit(source_file)
    return lowered.select(
        *projected,
        year.cast("short").alias("_year"),
        source.cast("string").alias("_source_file"),
    )


def losses(df: DataFrame, dataset: str) -> dict[str, Column]:
    """What `harmonize` will lose of a raw vintage, as aggregates by name; no job.

    ``lost:<column>`` counts texts of a numeric column that are no numbers and so become NULL, ``clash:<column>`` rows in
    which two columns feed a canonical one with different values, of which the first stays.
    """
    names = {c.lower(): c for c in df.columns}
    types = {c.lower(): t for c, t in df.dtypes}
    found = sources_of(dataset, list(names))
    out: dict[str, Column] = {}
    for spec in specs.columns(dataset):
        raw = {c: F.col(f"`{names[c]}`") for c in found[spec.name]}
        texts = [c for c in raw if types[c] == "string" and spec.type != "string"]
        if texts:
            bad = [F.when((F.trim(raw[c]) != "") & clean_value(raw[c], spec.name, "string", spec.type).isNull(), 1).otherwise(0) for c in texts]
            out[f"lost:{spec.name}"] = F.coalesce(F.sum(sum(bad[1:], bad[0])), F.lit(0)).cast("long")
        if len(raw) > 1:
            clean = [clean_value(v, spec.name, types[c], spec.type) for c, v in raw.items()]
            differ = [a != b for i, a in enumerate(clean) for b in clean[i + 1 :]]
            out[f"clash:{spec.name}"] = F.count_if(F.coalesce(F.greatest(*[F.coalesce(d, F.lit(False)) for d in differ], F.lit(False)), F.lit(False)))
    return out


def union_vintages(frames: list[DataFrame]) -> DataFrame:
    """All vintages as one table, matched by column name, absent columns NULL."""
    union, *rest = frames
    for frame in rest:
        union = union.unionByName(frame, allowMissingColumns=True)
    return union
