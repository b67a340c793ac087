"""Importance resampling towards a target: hashed n-gram features, weighed by how much commoner the target has them.

Texts are cut at newlines, which no word crosses. The corpus's distinct lines are found first, and each one's
features are computed once: its counts times its occurrences make the corpus's counts, its sum of gains
the weight of every place it stands in. The n-grams that run over a line's end belong to documents, not
lines, and are added for each document.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalframe.llm.spread import join_counted
from vitalframe.llm.text import ALNUM, LOWER, Slab, slabs
from vitalframe.sources.scratch import materialise

#: Features are hashed to so many buckets.
BUCKETS = 10_000
#: A feature is a run of up to so many words.
LONGEST = 3
_PLAIN = 32
_FULL = np.uint32(0xFFFFFFFF)


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1)
    return c


_CRC = _crc_table()


def extended(state: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 registers after the bytes starts..ends of each row: all rows byte by byte, words over 32 bytes one by one."""
    size = ends - starts
    order = np.argsort(-size, kind="stable")
    size, at, out = size[order], starts[order], state[order]
    left = np.searchsorted(-size, -np.arange(_PLAIN), "left")
    for j, n in enumerate(left):
        if not n:
            break
        out[:n] = _CRC[(out[:n] ^ data[at[:n] + j]) & 0xFF] ^ (out[:n] >> 8)
    for i in range(np.searchsorted(-size, -_PLAIN, "left")):
        out[i] = zlib.crc32(data[at[i] + _PLAIN : at[i] + size[i]], int(out[i] ^ _FULL)) ^ _FULL
    back = np.empty_like(out)
    back[order] = out
    return back


def _grams(slab: Slab, data: np.ndarray, first: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Owner text and bucket of the runs of 1, 2, ... words that begin at the words ``first[0]``, ``first[1]``, ..."""
    owner = np.repeat(np.arange(len(slab.first) - 1), np.diff(slab.first))
    begin = np.unique(np.concatenate(first))
    state, owners, buckets = np.full(len(begin), _FULL), [], []
    for n, wanted in enumerate(first):
        if n:
            longer = np.isin(begin, np.concatenate(first[n:]), assume_unique=False)
            begin, state = begin[longer], state[longer]
            state = _CRC[(state ^ 0x20) & 0xFF] ^ (state >> 8)
        state = extended(state, data, slab.starts[begin + n], slab.ends[begin + n])
        owners.append(owner[wanted])
        buckets.append((state[np.searchsorted(begin, wanted)] ^ _FULL) % BUCKETS)
    owners, buckets = np.concatenate(owners), np.concatenate(buckets)
    order = np.argsort(owners, kind="stable")
    return owners[order], buckets[order].astype(np.uint16)


def _starts(slab: Slab, n: int) -> np.ndarray:
    """Words with which a run of n words of one text begins."""
    owner = np.repeat(np.arange(len(slab.first) - 1), np.diff(slab.first))
    i = np.arange(max(len(owner) - n + 1, 0))
    return i[owner[i] == owner[i + n - 1]]


def _features(column: pa.Array, across: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By slab: words per text, features per text, and all features' buckets; ``across`` only those over a line's end."""
    for slab in slabs(column):
        slab.split(ALNUM)
        firsts = [_starts(slab, n) for n in range(1, LONGEST + 1)]
        if across:
            line = np.searchsorted(np.flatnonzero(slab.data == 0x0A), slab.starts)
            firsts = [i[line[i] != line[i + n]] for n, i in enumerate(firsts)]
        owner, bucket = _grams(slab, LOWER[slab.data], firsts)
        yield slab.n_words, np.bincount(owner, minlength=len(slab.first) - 1), bucket


def _packed(batch: pa.RecordBatch, column: str, across: bool) -> tuple[pa.Array, pa.Array]:
    """Words, and the features' buckets as two bytes each, of every text of a batch."""
    parts = list(_features(batch.column(column), across))
    words = np.concatenate([p[0] for p in parts] or [np.zeros(0, np.int64)])
    ends = np.cumsum(np.concatenate([p[1] for p in parts] or [np.zeros(0, np.int64)]))
    data = np.concatenate([p[2] for p in parts] or [np.zeros(0, np.uint16)])
    offsets = np.concatenate([[0], ends * data.itemsize])
    blobs = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(words), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return pa.array(words.astype(np.int64)), blobs.cast(pa.binary())


def _unpacked(blobs: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All buckets of a column, and how many each row has."""
    blobs = blobs.cast(pa.large_binary())
    _, where, what = blobs.buffers()
    offsets = np.frombuffer(where, np.int64, len(blobs) + 1 + blobs.offset)[blobs.offset :]
    data = np.frombuffer(what, np.uint8) if what is not None and what.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]].view(np.uint16), np.diff(offsets) // 2


def segments(docs: DataFrame, text_col: str = "text", **kept: Column) -> tuple[DataFrame, DataFrame]:
    """(lines, texts), both written to scratch: distinct lines (line, n, buckets), and for every row of ``docs``
    (row, the kept columns, n_words, lines, buckets), where ``lines`` are its lines' digests and ``buckets``
    those of its n-grams over line ends. Lines are told apart by their MD5 digests.
    """
    lines = F.filter(F.split(F.coalesce(text_col, F.lit("")), "\n"), lambda x: x != "")
    counted = docs.select(F.explode(lines).alias("text")).groupBy("text").agg(F.count("*").alias("n"))
    counted = counted.select(F.unhex(F.md5("text")).alias("line"), "n", "text")

    def of_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("line"), b.column("n"), _packed(b, "text", False)[1]], ["line", "n", "buckets"])

    def of_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words, buckets = _packed(b, "text", True)
            rest = [c for c in b.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in rest), words, buckets], [*rest, "n_words", "buckets"])

    found = materialise(counted.mapInArrow(of_lines, "line binary, n long, buckets binary"), "lines")
    digests = F.transform(lines, lambda x: F.unhex(F.md5(x)))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), *[c.alias(name) for name, c in kept.items()], digests.alias("lines"), F.col(text_col).alias("text")
    )
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    return found, materialise(rows.mapInArrow(of_texts, f"{schema}, n_words long, buckets binary"), "texts")


def bucket_counts(lines: DataFrame, texts: DataFrame) -> DataFrame:
    """(bucket, n): every line's features times its occurrences, and those over line ends. At most BUCKETS rows."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for b in batches:
            buckets, size = _unpacked(b.column("buckets"))
            np.add.at(total, buckets, np.repeat(np.asarray(b.column("n")), size))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["bucket", "n"])

    both = lines.select("n", "buckets").unionByName(texts.select(F.lit(1).cast("long").alias("n"), "buckets"))
    return both.mapInArrow(summed, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame) -> np.ndarray:
    """Gain of every bucket: 1000 times the logarithm of its smoothed target share over its corpus share, floored."""
    counts = corpus.select("bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t")).unionByName(
        target.select("bucket", F.lit(0).cast("long").alias("s"), F.col("n").alias("t"))
    )
    every = corpus.sparkSession.range(BUCKETS).select(F.col("id").alias("bucket"), *[F.lit(0).cast("long").alias(c) for c in "st"])
    counted = counts.unionByName(every).groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t"))
    everything = Window.partitionBy(F.lit(1))
    s, t, ss, tt = (x.cast("double") for x in (F.col("s"), F.col("t"), F.sum("s").over(everything), F.sum("t").over(everything)))
    gain = F.floor(1000 * F.log(((t + 1) * (ss + BUCKETS)) / ((s + 1) * (tt + BUCKETS))))
    rows = counted.select("bucket", gain.alias("gain")).collect()
    out = np.zeros(BUCKETS, np.int64)
    for r in rows:
        out[r.bucket] = r.gain
    return out


def _weighed(frame: DataFrame, gain: np.ndarray) -> DataFrame:
    """``weight`` and ``features``, the sum and number of the row's buckets' gains, in place of ``buckets``."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            buckets, size = _unpacked(b.column("buckets"))
            total = np.concatenate([[0], np.cumsum(gain[buckets])])
            ends = np.concatenate([[0], np.cumsum(size)])
            rest = [c for c in b.schema.names if c != "buckets"]
            weight = pa.array(total[ends[1:]] - total[ends[:-1]])
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in rest), weight], [*rest, "weight"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema if f.name != "buckets")
    return frame.mapInArrow(weigh, f"{schema}, weight long")


def gumbel(id_col: str | Column, seed: int) -> Column:
    """1000 times a standard Gumbel variate, floored, drawn from the digest of seed and id; a null id reads as an empty one."""
    said = F.concat(F.lit(f"{seed}:"), F.coalesce((F.col(id_col) if isinstance(id_col, str) else id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(said, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def ranked(scored: DataFrame, percent: int, least_words: int) -> DataFrame:
    """``rank`` of the highest ``percent`` of the rows with enough words, by score, ties to the smaller id; others null.

    A sketch whose rank error is under a tenth of a percent first leaves out rows that can't be drawn. The rest
    are range-sorted and counted by partition, so a rank is its partition's offset plus a place in it.
    """
    eligible = scored.where(F.col("n_words") >= least_words).select("row", "doc_id", "score")
    at = max(0.0, 1 - percent / 100 - 0.005)
    n, floor = eligible.agg(F.count("*"), F.percentile_approx("score", at, 10_000)).first()
    drawn = percent * n // 100
    ordered = eligible.where(F.col("score") >= (floor or 0)).repartitionByRange(F.desc("score"), F.asc_nulls_first("doc_id"), "row")
    placed = materialise(ordered.withColumn("part", F.spark_partition_id()), "drawn")
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("before"))
    within = Window.partitionBy("part").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"), "row")
    ranks = placed.withColumn("place", F.row_number().over(within)).join(F.broadcast(offsets), "part")
    ranks = ranks.select("row", (F.col("place") + F.col("before")).cast("long").alias("rank")).where(F.col("rank") <= drawn)
    return scored.join(ranks, "row", "left")


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 5,
    least_words: int = 20,
    seed: int = 42,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    carry: str | None = None,
) -> DataFrame:
    """Score every document for likeness to the target's texts plus a Gumbel variate, and rank the drawn ones.

    Returns one row per row of ``docs``: doc_id, n_words, n_features, weight, score, rank. The drawn documents
    are those with a rank: ``percent`` of the documents of at least ``least_words`` words. ``carry`` names a
    struct column that then holds all columns of ``docs``, texts included.

    A null or empty text has no words, no features and weight 0. Rows with the same id are documents of their
    own; they draw the same variate. A null id draws that of an empty one and is smaller than any. Without
    target texts the gains are those of an empty target; an empty ``docs`` gives an empty table.
    """
    kept = {"doc_id": F.col(id_col)} | ({"doc": F.struct(*docs.columns)} if carry else {})
    lines, texts = segments(docs, text_col, **kept)
    gain = gains(bucket_counts(lines, texts), bucket_counts(*segments(target, target_text_col)))
    places = texts.select("row", F.explode("lines").alias("line"))
    summed = join_counted(places, _weighed(lines, gain), "line", "n").groupBy("row").agg(F.sum("weight").alias("inside"))
    own = _weighed(texts.drop("lines"), gain).join(summed, "row", "left")
    weight = F.col("weight") + F.coalesce("inside", F.lit(0))
    runs = sum((F.greatest(F.col("n_words") - n, F.lit(0)) for n in range(LONGEST)), F.lit(0).cast("long"))
    scored = own.select(
        "row",
        "doc_id",
        "n_words",
        runs.alias("n_features"),
        weight.alias("weight"),
        (weight + gumbel("doc_id", seed)).alias("score"),
        *([F.col("doc").alias(carry)] if carry else []),
    )
    return ranked(materialise(scored, "scored"), percent, least_words).drop("row")
