"""Correlations of many columns from Gram matrices.

Every task turns its rows into matrix products, column by column, and keeps counts, means and centred products of each
pair of columns over the rows that hold both. Bands of these matrices, a few columns high, are merged on the cluster,
so neither a plan nor a task grows with the square of the columns.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Columns of a band, rows taken at a time, and partial bands that are merged before the last merge.
BAND, ROWS, FIRST_MERGE = 64, 4096, 64
#: Matrices of a band: rows with both, means of either, centred squares of either, centred products.
PARTS = 6


def _products(x: np.ndarray, present: np.ndarray) -> np.ndarray:
    """The matrices of some rows. Values are taken from about their column's mean, so large offsets cost no digits."""
    there = np.maximum(present.sum(0), 1)
    low = np.where(present, x, np.inf).min(0, initial=np.inf)
    high = np.where(present, x, -np.inf).max(0, initial=-np.inf)
    base = np.where(low == high, low, np.where(present, x, 0).sum(0) / there)
    base = np.where(np.isfinite(base), base, 0.0)
    d = np.where(present, x - base, 0.0)
    m = present.astype(float)
    n = m.T @ m
    many = np.maximum(n, 1)
    sums, squares = d.T @ m, (d * d).T @ m
    mean_a, mean_b = sums / many, sums.T / many
    square_a = np.maximum(squares - sums * mean_a, 0)
    square_b = np.maximum(squares.T - sums.T * mean_b, 0)
    return np.stack([n, mean_a + base[:, None], mean_b + base, square_a, square_b, d.T @ d - sums * mean_b])


def _merged(p: np.ndarray | None, q: np.ndarray) -> np.ndarray:
    """The matrices of two lots of rows together."""
    if p is None:
        return q
    n = p[0] + q[0]
    of_q = q[0] / np.maximum(n, 1)
    # A pair without rows on one side has no mean there.
    da, db = (np.where((p[0] > 0) & (q[0] > 0), q[i] - p[i], 0.0) for i in (1, 2))
    mean_a, mean_b = (np.where(p[0] > 0, p[i] + d * of_q, q[i]) for i, d in ((1, da), (2, db)))
    cross = p[0] * of_q
    return np.stack([n, mean_a, mean_b, p[3] + q[3] + da * da * cross, p[4] + q[4] + db * db * cross, p[5] + q[5] + da * db * cross])


def _summing(width: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for part in parts:
            for lo in range(0, part.num_rows, ROWS):
                some = part.slice(lo, ROWS)
                x = np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in some.columns], 1)
                total = _merged(total, _products(x, ~np.isnan(x)))
        for band, lo in enumerate(range(0, width, BAND) if total is not None else ()):
            blob = np.ascontiguousarray(total[:, lo : lo + BAND]).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([band]), pa.array([blob], pa.binary())], ["band", "blob"])

    return run


def _merging(width: int):
    """Partial bands, read one by one, to one for each band of the partition."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for part in parts:
            for band, blob in zip(part.column("band").to_pylist(), part.column("blob")):
                found = np.frombuffer(blob.as_buffer(), float).reshape(PARTS, -1, width)
                held[band] = _merged(held.get(band), found)
        for band, total in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([band]), pa.array([total.tobytes()], pa.binary())], ["band", "blob"])

    return run


def _correlating(width: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for band, blob in zip(part.column("band").to_pylist(), part.column("blob")):
                n, _, _, aa, bb, ab = np.frombuffer(blob.as_buffer(), float).reshape(PARTS, -1, width)
                scale = np.sqrt(aa) * np.sqrt(bb)
                known = (n > 1) & (scale > 0)
                r = np.clip(ab / np.where(known, scale, 1), -1, 1)
                a, b = np.indices(n.shape)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x.ravel()) for x in (a + band * BAND, b, n.astype(np.int64))] + [pa.array(r.ravel(), mask=~known.ravel())],
                    ["i", "j", "n", "r"],
                )

    return run


def wide_correlations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(a, b, n, r)``: Pearson's r of every ordered pair of columns over the ``n`` rows that hold both, in one pass.

    NULL and NaN are missing. ``r`` is NULL with fewer than two such rows or if a column is constant in them. No rows
    give no pairs. Meant for hundreds of columns; names may be any text.
    """
    width = len(cols)
    numbers = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    partial = numbers.mapInArrow(_summing(width), "band long, blob binary").withColumn("_lot", F.pmod(F.spark_partition_id(), F.lit(FIRST_MERGE)))
    fewer = partial.repartition("band", "_lot").select("band", "blob").mapInArrow(_merging(width), "band long, blob binary")
    whole = fewer.repartition("band").mapInArrow(_merging(width), "band long, blob binary")
    found = whole.mapInArrow(_correlating(width), "i long, j long, n long, r double")
    names = F.array(*map(F.lit, cols))
    return found.select(F.get(names, F.col("i").cast("int")).alias("a"), F.get(names, F.col("j").cast("int")).alias("b"), "n", "r")


def wide_ranking(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Unordered pairs ``(a, b, n, r)`` of different columns by falling absolute correlation, rounded to four decimals."""
    at = F.array(*map(F.lit, cols))
    pairs = wide_correlations(df, cols).where(F.array_position(at, F.col("a")) < F.array_position(at, F.col("b")))
    return pairs.withColumn("r", F.round("r", 4)).orderBy(F.abs("r").desc_nulls_last(), "a", "b")
