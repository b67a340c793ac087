"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight schedule: weights at equally spaced times, linear in between. Its integral is the
source's share of all words, and its running integral says how many of the source's words training has asked
for by any time. A document's place in its source's order, in words, is inverted through that curve to a
training position; the mix is all documents sorted by position.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalframe.llm.spread import running, shuffled

#: Weights of the sources in order, repeating.
WEIGHTS = (3.0, 1.0, 2.0)
#: Shapes of the schedules in order, repeating: rising, falling, early peak. Each is scaled to its source's weight.
SHAPES = ((0.5, 1.0, 1.5), (1.5, 1.0, 0.5), (1.0, 1.25, 0.5))
SHARE = 1.5
MOST = 2.0


def n_words(text: str) -> Column:
    """Number of words `[^\\x20\\x09-\\x0D]+`; none in a null text."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _pick(values: Sequence, i: Column) -> Column:
    listed = F.array(*[F.array(*map(F.lit, v)) if isinstance(v, tuple) else F.lit(v) for v in values])
    return F.element_at(listed, (F.pmod(i, F.lit(len(values))) + 1).cast("int"))


def source_targets(sized: DataFrame, weights=WEIGHTS, shapes=SHAPES, share: float = SHARE, most: float = MOST) -> DataFrame:
    """One row a source: words, weight, target, and the normalised integral of its schedule at its knots.

    Targets divide ``share`` times all words by weight. A target stops at ``most`` times its source's words, and
    what it leaves is shared again by weight among the others: in the order of the words per weight at which
    they stop, a source stops if what is left per weight is above its own stop.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = sources.withColumn("i", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    ranked = ranked.withColumns({"weight": _pick(weights, F.col("i")), "shape": _pick(shapes, F.col("i"))})
    ranked = ranked.withColumns({"cap": F.lit(most) * F.col("source_size"), "stop": F.lit(most) * F.col("source_size") / F.col("weight")})
    order = Window.orderBy("stop", "i")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.lit(share) * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    ranked = ranked.withColumn("level", left / F.sum("weight").over(after))
    ranked = ranked.withColumn("stops", F.col("level") > F.col("stop"))
    final = F.min_by(F.when(~F.col("stops"), F.col("level")), F.when(~F.col("stops"), F.struct("stop", "i"))).over(everything)
    ranked = ranked.withColumn("target", F.when(F.col("stops"), F.col("cap")).otherwise(F.least("cap", F.col("weight") * final)))
    steps = F.transform(F.sequence(F.lit(1), F.size("shape") - 1), lambda j: (F.get("shape", j - 1) + F.get("shape", j)) / 2)
    sums = F.transform(F.sequence(F.lit(0), F.size("shape") - 1), lambda j: F.aggregate(F.slice(steps, 1, j), F.lit(0.0), lambda s, x: s + x))
    total = F.aggregate(steps, F.lit(0.0), lambda s, x: s + x)
    ranked = ranked.withColumns({"knots": F.transform(sums, lambda x: x / total), "speeds": F.transform("shape", lambda x: x / total)})
    return ranked.select("source", "source_size", "weight", "target", "knots", "speeds")


def position(demand: Column) -> Column:
    """Time from 0 to 1 at which a source's running integral reaches a share of its demand.

    Within a segment the integral is quadratic: speed x + slope x^2 / 2, solved in the form that stays exact
    when the slope is zero.
    """
    segments = F.size("knots") - 1
    j = F.least(F.size(F.filter("knots", lambda x: x <= demand)), segments) - 1
    rest, v, slope = demand - F.get("knots", j), F.get("speeds", j), F.get("speeds", j + 1) - F.get("speeds", j)
    x = 2 * rest / (v + F.sqrt(F.greatest(v * v + 2 * slope * rest, F.lit(0.0))))
    return F.when(rest <= 0, j / segments).otherwise((j + F.least(x, F.lit(1.0))) / segments)


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", carry: str | None = None, **schedule
) -> DataFrame:
    """Decide what training takes of every document, and when.

    Within a source, documents stand in a reproducible random order (by a digest of the id, then id and size)
    and are taken from the front, again from the front where the target asks for more than the source has; the
    document at the cut gives its first words only. Returns (doc_id, source, size, source_size, target, taken,
    passes): ``passes`` lists (position, words) of each time the document is read, positions from 0 to 1. ``carry``
    names a struct column that then holds all columns of ``docs``.

    A null text has size 0; documents of size 0 are never taken. Null is a source of its own, sorted last. Rows
    with the same id are documents of their own; if they agree in size as well they are interchangeable. An
    empty table gives an empty one; other columns are ignored.
    """
    carried = [F.struct(*docs.columns).alias(carry)] if carry else []
    sized = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), n_words(text_col).alias("size"), *carried
    )
    sources = source_targets(sized.select("source", "size"), **schedule).withColumnRenamed("source", "_source")
    ordered = sized.withColumn("key", shuffled(F.col("doc_id")))
    ordered = running(ordered, ["source"], "key", ["doc_id", "size"], {"start": F.col("size")})
    rows = ordered.join(sources, F.col("source").eqNullSafe(F.col("_source")))
    asked = F.round("target").cast("long")
    pieces = F.filter(
        F.transform(
            F.array(F.lit(0), F.col("source_size")),
            lambda at: F.struct(
                position(F.try_divide(at + F.col("start"), F.col("target"))).alias("position"),
                F.greatest(F.lit(0), F.least(F.col("size"), asked - at - F.col("start"))).cast("long").alias("words"),
            ),
        ),
        lambda p: p["words"] > 0,
    )
    rows = rows.withColumn("passes", pieces)
    taken = F.aggregate("passes", F.lit(0).cast("long"), lambda s, p: s + p["words"])
    return rows.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"), "passes", *([carry] if carry else []))


def curriculum(mixed: DataFrame) -> DataFrame:
    """The training sequence: one row per reading of a document, range-sorted by position."""
    read = mixed.select("doc_id", "source", F.posexplode("passes").alias("pass", "p"))
    return read.select("doc_id", "source", "pass", F.col("p.position"), F.col("p.words")).orderBy("position", "doc_id", "pass")
