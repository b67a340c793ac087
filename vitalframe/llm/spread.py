"""Shuffles that stay even: positions within huge groups, blobs dealt to buckets, components."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from vitalframe.sources.scratch import materialise

_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Python tasks planned inside take at most ``rows`` rows at a time; a smaller setting of the session stays.

    Texts may be long, so a batch is large by its bytes long before it is by its rows.
    """
    before = spark.conf.get(_BATCH_SETTING)
    if not 0 < int(before) <= rows:
        spark.conf.set(_BATCH_SETTING, str(rows))
    try:
        yield
    finally:
        spark.conf.set(_BATCH_SETTING, before)


def width(spark: SparkSession) -> int:
    """Shuffle width that the session is set to."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Shuffle partitions whose rows of ids one file takes.
FILE_PARTITIONS = 16


def few(df: DataFrame) -> DataFrame:
    """Rows of ids, a hundredth of the texts that the shuffle width is set for, in fewer partitions; no fewer than there are cores.

    Written as they are, they would make a file a partition in every round. On a local folder each file costs three
    processes (`chmod`), and while one starts, the executor's memory counts twice.
    """
    spark = df.sparkSession
    return df.coalesce(max(spark.sparkContext.defaultParallelism, width(spark) // FILE_PARTITIONS))


def listed(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Few rows of the driver as a table that Spark's plan holds itself.

    A plain list would be read by Python workers of a kind of its own, which stay in memory beside those of the Arrow steps.
    """
    kinds = to_arrow_schema(StructType.fromDDL(schema))
    columns = list(zip(*rows)) if rows else [()] * len(kinds)
    return spark.createDataFrame(pa.table([list(c) for c in columns], schema=kinds))


def shuffled(*parts: Column) -> Column:
    """A reproducible random order: the MD5 digest of the parts, in hexadecimal; the key that `running` takes."""
    return F.md5(F.concat_ws("\x1f", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def running(df: DataFrame, group: list[str], key: str, ties: list[str], values: dict[str, Column]) -> DataFrame:
    """Exclusive running sums of ``values`` within ``group`` in the order of ``key``, then ``ties``.

    ``key`` is a hexadecimal digest, so its first three digits cut any group into 4,096 even slices: each
    slice is summed on its own, the slices' totals are summed in order, and both are added. A group of any
    size is never in one task. Groups may be null. Rows that agree in key and ties are interchangeable.
    """
    sliced = df.withColumn("_slice", F.substring(key, 1, 3))
    sliced = sliced.withColumns({f"_v_{name}": value for name, value in values.items()})
    at = [*group, "_slice"]
    within = Window.partitionBy(*at).orderBy(key, *ties).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    inner = sliced.withColumns(
        {f"_in_{name}": F.coalesce(F.sum(f"_v_{name}").over(within), F.lit(0)) for name in values}
    )
    totals = sliced.groupBy(*at).agg(*[F.sum(f"_v_{name}").alias(f"_sum_{name}") for name in values])
    totals = totals.select(
        *[F.col(c).alias(f"_at_{c}") for c in at],
        *[F.coalesce(F.sum(f"_sum_{name}").over(before), F.lit(0)).alias(f"_off_{name}") for name in values],
    )
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_at_{c}")) for c in at])
    joined = inner.join(totals, same)
    return joined.select(*df.columns, *[(F.col(f"_in_{n}") + F.col(f"_off_{n}")).alias(n) for n in values])


#: A key with more than one in so many of all rows is hot; there are at most as many hot keys.
HOT_SHARE = 4096


def join_counted(left: DataFrame, right: DataFrame, key: str, n: str) -> DataFrame:
    """Inner join of ``left`` with ``right``, which holds every key once and in ``n`` how many rows of ``left`` have it.

    Keys with more than 1 in ``HOT_SHARE`` of these rows, of which there can be no more than that, go by
    broadcast, the others by shuffle, so no task gets a hot key's rows. Both frames are read twice.
    """
    least = (right.agg(F.sum(n)).first()[0] or 0) // HOT_SHARE
    hot, cold = right.where(F.col(n) > least), right.where(F.col(n) <= least)
    by_broadcast = left.join(F.broadcast(hot), key)
    rest = left.join(F.broadcast(hot.select(key)), key, "left_anti")
    return by_broadcast.unionByName(rest.join(cold, key))


#: Bits that tell which keys are wanted, 1 MB of them, in pieces as large as Spark's bitmaps.
WANTED_BITS, PIECE_BITS = 1 << 23, 1 << 15


def among(df: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """Rows of ``df`` whose ``key`` may be in ``wanted``, which has one column: all that are, and few others; no shuffle of ``df``.

    The wanted keys are bits of a map of fixed size, which is broadcast in pieces. With more keys than it has bits for,
    more other rows pass, so an exact join should follow.
    """
    slot = F.pmod(F.xxhash64(F.col(key)), F.lit(WANTED_BITS))
    marks = wanted.select(F.col(wanted.columns[0]).cast(df.schema[key].dataType).alias(key)).select(slot.alias("_slot"))
    piece, bit = F.floor(F.col("_slot") / PIECE_BITS), F.col("_slot") % PIECE_BITS
    pieces = marks.select(piece.alias("_piece"), bit.alias("_bit")).groupBy("_piece").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    held = df.withColumn("_slot", slot).withColumns({"_at": piece, "_bit": bit})
    byte = F.conv(F.hex(F.substring("_bits", F.floor(F.col("_bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    shown = F.getbit(byte, (F.col("_bit") % 8).cast("int")) == 1
    return held.join(F.broadcast(pieces), F.col("_at") == F.col("_piece")).where(shown).select(*df.columns)


def dealt(bucket: np.ndarray, records: np.ndarray) -> pa.RecordBatch | None:
    """One row per bucket: the bucket and its fixed-width records, packed, in their given order."""
    if not len(bucket):
        return None
    order = np.argsort(bucket, kind="stable")
    kinds, at = np.unique(bucket[order], return_index=True)
    packed = np.ascontiguousarray(records[order]).view(np.uint8).reshape(-1)
    ends = np.append(at[1:], len(order)) * records.dtype.itemsize
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    blobs = pa.BinaryArray.from_buffers(pa.binary(), len(kinds), [None, pa.py_buffer(offsets), pa.py_buffer(packed)])
    return pa.RecordBatch.from_arrays([pa.array(kinds.astype(np.int64)), blobs], ["bucket", "blob"])


def gathered(column: pa.ChunkedArray | pa.Array, dtype: np.dtype) -> np.ndarray:
    """All records of a column of blobs."""
    parts = [np.frombuffer(b, dtype) for b in (x.as_buffer() for x in column) if b is not None]
    return np.concatenate(parts) if parts else np.zeros(0, dtype)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node that each linked node reaches.

    Labels spread over the edges, then each node takes its label's label, so chains of length n take about
    log n rounds. Each round is written to the shared scratch folder; nothing is gathered on the driver.
    """
    pairs = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x <> y")
    both = materialise(few(pairs.union(pairs.select("y", "x")).distinct()), "edges")
    labels = materialise(few(both.groupBy(F.col("x").alias("node")).agg(F.least(F.min("y"), F.first("x")).alias("label"))), "labels")
    while True:
        near = both.join(labels, both.y == labels.node).groupBy(F.col("x").alias("node")).agg(F.min("label").alias("near"))
        met = labels.join(near, "node").select("node", F.least("label", "near").alias("met"), F.col("label").alias("old"))
        jump = labels.select(F.col("node").alias("met"), F.col("label").alias("jump"))
        after = materialise(
            few(met.join(jump, "met", "left").select("node", F.least("met", F.coalesce("jump", "met")).alias("label"), "old")), "labels"
        )
        changed = after.where("label <> old").limit(1).count()
        labels = after.select("node", "label")
        if not changed:
            return labels.select("node", F.col("label").alias("component"))


def batches(table: pa.Table, rows: int = 10_000) -> Iterator[pa.RecordBatch]:
    yield from table.to_batches(max_chunksize=rows)
