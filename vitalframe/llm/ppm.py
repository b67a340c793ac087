"""Language-model scoring by partial matching (PPM): a byte-context trie pretrained on the corpus.

The trie is a set of tables: how often each byte follows each context of up to ORDER bytes. A byte seen in its
longest context takes its share of what the context doesn't keep for new bytes; any other escapes to the context
one byte shorter, where the bytes already seen in the longer one are excluded by renormalising. The
probability of a byte in context is one number per n-gram, so it is computed once per distinct n-gram, by joins and
window sums, and documents only look it up and add up.

Documents are grouped in chunks of bounded size. A chunk asks for its distinct n-grams and words and gets their values
back, so neither the trie nor the vocabulary is ever whole in one place.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalframe.llm.spread import width
from vitalframe.llm.text import LOWER, SPACED, Slab, mixed, slabs
from vitalframe.sources.scratch import materialise

#: Bytes of context.
ORDER = 5
#: UTF-8 bytes of text in a chunk.
CHUNK_BYTES = 16 << 20
#: Stands before a text and ends it; never part of UTF-8.
EDGE = 0xFF

COUNT = np.dtype([("key", "<u8"), ("count", "<u4")])
VALUE = np.dtype([("key", "<u8"), ("value", "<f8")])
GRAM, TOKEN = 0, 1


def grams(slab: Slab, order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """Each byte and each end with its context, packed into one integer; and how many each text has."""
    lengths = np.diff(slab.offsets)
    n = len(lengths)
    padded = np.full(len(slab.data) + (order + 1) * n, EDGE, np.uint8)
    before = (order + 1) * np.arange(n) + order
    padded[np.arange(len(slab.data)) + np.repeat(before, lengths)] = slab.data
    counts = lengths + 1
    at = np.arange(counts.sum()) + np.repeat(order * (np.arange(n) + 1), counts)
    code = np.zeros(len(at), np.uint64)
    for back in range(order, -1, -1):
        code = (code << np.uint64(8)) | padded[at - back].astype(np.uint64)
    return code, counts


def tokens(slab: Slab) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words and of one end (0) per text, and how many each text has."""
    slab.split(SPACED)
    counts = slab.n_words + 1
    out = np.zeros(counts.sum(), np.uint64)
    owner = np.repeat(np.arange(len(counts)), slab.n_words)
    out[np.arange(len(owner)) + owner] = slab.hashes()
    return out, counts


def _lower(slab: Slab) -> Slab:
    slab.data = LOWER[slab.data]
    return slab


def _added(parts: list[np.ndarray]) -> np.ndarray:
    """Records of equal keys added up."""
    both = np.concatenate(parts)
    keys, at = np.unique(both["key"], return_inverse=True)
    out = np.zeros(len(keys), COUNT)
    out["key"] = keys
    out["count"] = np.bincount(at, both["count"], len(keys))
    return out


class _Tally:
    """Distinct keys of many slabs with their counts in training texts."""

    def __init__(self):
        self.parts: list[np.ndarray] = []
        self.held = 0

    def add(self, keys: np.ndarray, trains: np.ndarray) -> None:
        for learn in (True, False):
            some = np.sort(keys[trains == learn])
            at = np.flatnonzero(np.append(True, some[1:] != some[:-1])) if len(some) else np.zeros(0, np.int64)
            out = np.zeros(len(at), COUNT)
            out["key"] = some[at]
            if learn:
                out["count"] = np.diff(np.append(at, len(some)))
            self.parts.append(out)
            self.held += len(out)
        if self.held > 4_000_000:
            self.parts = [_added(self.parts)]
            self.held = len(self.parts[0])

    def sorted(self) -> np.ndarray:
        return _added(self.parts) if self.parts else np.zeros(0, COUNT)


def _asked(column: pa.Array, held: np.ndarray, tallies: tuple[_Tally, _Tally], order: int) -> None:
    for slab in slabs(column):
        trains = ~held[slab.lo : slab.hi]
        for tally, (keys, counts) in zip(tallies, (grams(_lower(slab), order), tokens(slab))):
            tally.add(keys, np.repeat(trains, counts))


def _requests(tallies: tuple[_Tally, _Tally], bits: int, chunk: int) -> Iterator[pa.RecordBatch]:
    for kind, tally in enumerate(tallies):
        records = tally.sorted()
        if not len(records):
            continue
        bucket = (mixed(records["key"] + np.uint64(1)) >> np.uint64(64 - bits)).astype(np.int64) + (kind << bits)
        order = np.argsort(bucket, kind="stable")
        kinds, at = np.unique(bucket[order], return_index=True)
        records = records[order]
        blobs = [records[a:b].tobytes() for a, b in zip(at, [*at[1:], len(records)])]
        yield pa.RecordBatch.from_arrays(
            [pa.array(kinds), pa.array(np.full(len(kinds), chunk, np.int64)), pa.array(blobs, pa.binary())], ["bucket", "chunk", "blob"]
        )


_REQUEST = "bucket long, chunk long, blob binary"


def _surveying(bits: int, order: int):
    """Counts of whatever passes by, a chunk's worth at a time."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tallies, much = (_Tally(), _Tally()), 0
        for part in parts:
            _asked(part.column("text"), part.column("held_out").to_numpy(zero_copy_only=False).astype(bool), tallies, order)
            much += part.column("text").nbytes
            if much >= CHUNK_BYTES:
                yield from _requests(tallies, bits, 0)
                tallies, much = (_Tally(), _Tally()), 0
        if much:
            yield from _requests(tallies, bits, 0)

    return run


def _asking(bits: int, order: int):
    """What a chunk wants to know."""

    def run(table: pa.Table) -> pa.Table:
        tallies = (_Tally(), _Tally())
        _asked(table.column("text"), table.column("held_out").to_numpy().astype(bool), tallies, order)
        return pa.Table.from_batches(list(_requests(tallies, bits, table.column("chunk")[0].as_py())))

    return run


def _totalling(table: pa.Table) -> pa.Table:
    """One bucket: each key's count in all training texts."""
    parts = [np.frombuffer(b.as_buffer(), COUNT) for b in table.column("blob")]
    both = np.concatenate(parts)
    keys, at = np.unique(both["key"], return_inverse=True)
    count = np.bincount(at, both["count"], len(keys)).astype(np.int64)
    bucket = np.full(len(keys), table.column("bucket")[0].as_py())
    return pa.table({"bucket": bucket, "key": keys.view(np.int64), "count": count})


def _answering(asked: pa.Table, known: pa.Table) -> pa.Table:
    """One bucket: the values of what each chunk asked for."""
    key, value = known.column("key").to_numpy().view(np.uint64), known.column("value").to_numpy()
    order = np.argsort(key)
    key, value = key[order], value[order]
    blobs = []
    for blob in asked.column("blob"):
        want = np.frombuffer(blob.as_buffer(), COUNT)["key"]
        out = np.empty(len(want), VALUE)
        out["key"], out["value"] = want, value[np.searchsorted(key, want)]
        blobs.append(out.tobytes())
    return pa.table({"bucket": asked.column("bucket"), "chunk": asked.column("chunk"), "blob": pa.array(blobs, pa.binary())})


def _scoring(bits: int, order: int):
    """One chunk: look up and add up."""

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        bucket = answers.column("bucket").to_numpy()
        blobs = answers.column("blob")
        looked = []
        for kind in (GRAM, TOKEN):
            parts = [np.frombuffer(blobs[int(i)].as_buffer(), VALUE) for i in np.flatnonzero(bucket >> bits == kind)]
            both = np.sort(np.concatenate(parts), order="key") if parts else np.zeros(0, VALUE)
            looked.append((np.ascontiguousarray(both["key"]), np.ascontiguousarray(both["value"])))
        (gram_keys, logs), (token_keys, counts) = looked
        count_logs = np.log10(counts + 0.5)
        out = []
        for slab in slabs(docs.column("text")):
            codes, n_codes = grams(_lower(slab), order)
            score = np.add.reduceat(logs[np.searchsorted(gram_keys, codes)], np.cumsum(n_codes) - n_codes)
            words, n_tokens = tokens(slab)
            at, begin = np.searchsorted(token_keys, words), np.cumsum(n_tokens) - n_tokens
            known = np.add.reduceat((counts[at] > 0).astype(np.int64), begin)
            out.append((n_tokens, known, np.add.reduceat(count_logs[at], begin), score))
        n_tokens, known, words_sum, score = (np.concatenate(x) for x in zip(*out))
        return pa.table(
            {"doc_id": docs.column("doc_id"), "held_out": docs.column("held_out"), "n_tokens": n_tokens, "n_known": known, "words_sum": words_sum, "score": score}
        )

    return run


def _size_class(n: Column) -> Column:
    """Half octaves of a count."""
    return F.floor(2 * F.log2(n.cast("double"))).cast("int")


def byte_probabilities(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """log10 probability of the last byte of each n-gram after the others: (bucket, key, value).

    ``counts`` has every n-gram that anybody asks for, seen in training (count > 0) or not. The escape of a context
    is learnt for all contexts of its length, size and variety together, by leaving one out: a byte seen once in its
    context would have been new to it.
    """
    levels = [counts.select("bucket", F.col("key").alias("gram"), F.col("count").alias("c"))]
    for k in range(order, 0, -1):
        shorter = F.col("gram").bitwiseAND(F.lit((1 << (8 * k)) - 1))
        levels.append(levels[-1].groupBy(shorter.alias("gram")).agg(F.sum("c").alias("c")))
    levels.reverse()
    seen = F.col("c") > 0

    def classes(k: int) -> DataFrame:
        stats = levels[k].where(seen).groupBy(F.shiftright("gram", 8).alias("context"))
        stats = stats.agg(F.sum("c").alias("all"), F.count("*").alias("distinct"), F.sum((F.col("c") == 1).cast("long")).alias("once"))
        stats = stats.where("all > 1")
        size, q = _size_class(F.col("all") - 1), F.col("distinct")
        new = stats.where("once > 0 AND distinct > 1").select(size.alias("size"), _size_class(q - 1).alias("variety"), "once", F.lit(0).alias("again"))
        old = stats.select(size.alias("size"), _size_class(q).alias("variety"), F.lit(0).alias("once"), (F.col("all") - F.col("once")).alias("again"))
        both = new.union(old).groupBy("size", "variety").agg(((F.sum("once") + 0.5) / (F.sum("once") + F.sum("again") + 1)).alias("escape"))
        return both.select(F.lit(k).alias("k"), "size", "variety", "escape")

    # Size and variety are half octaves of counts, so these are a few hundred rows for any input.
    table = [classes(k) for k in range(order + 1)]
    learnt = reduce(DataFrame.union, table).collect()
    escapes = counts.sparkSession.createDataFrame([tuple(r) for r in learnt], "_k int, _size int, _variety int, escape double")

    below = None
    for k, level in enumerate(levels):
        if below is None:
            joined = level.withColumn("p", F.lit(1 / 256))
        else:
            last = F.col("gram").bitwiseAND(F.lit((1 << (8 * k)) - 1))
            joined = level.join(below.select(F.col("gram").alias("_short"), "p"), last == F.col("_short")).drop("_short")
        context = Window.partitionBy(F.shiftright("gram", 8))
        joined = joined.withColumns(
            {
                "all": F.sum("c").over(context),
                "distinct": F.sum(seen.cast("int")).over(context),
                "seen_p": F.sum(F.when(seen, F.col("p")).otherwise(0.0)).over(context),
            }
        )
        sized = F.when(F.col("all") > 0, _size_class(F.greatest("all", F.lit(1))))
        varied = F.when(F.col("all") > 0, _size_class(F.greatest("distinct", F.lit(1))))
        here = escapes.where(F.col("_k") == k).drop("_k")
        joined = joined.join(F.broadcast(here), (sized == F.col("_size")) & (varied == F.col("_variety")), "left")
        escape = F.coalesce("escape", F.try_divide(F.col("distinct").cast("double"), 2.0 * F.col("all")))
        escaped = escape * F.col("p") / F.greatest(F.lit(1e-12), 1 - F.col("seen_p"))
        p = F.when(F.col("all") == 0, F.col("p")).when(seen, (1 - escape) * F.try_divide(F.col("c").cast("double"), F.col("all"))).otherwise(escaped)
        below = joined.withColumn("p", p).drop("all", "distinct", "seen_p", "_size", "_variety", "escape")
    return below.select("bucket", F.col("gram").alias("key"), F.log10("p").alias("value"))


def score_texts(
    docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """Score every text by PPM and by a word-unigram base, both learnt from the rows that are not held out.

    A-Z count as a-z. Returns (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score); tokens are the
    words and one end a text. ``score`` is the log10 probability of all bytes and the end, ``base_score`` the sum
    of log10((c + 0.5) / (N + 0.5 (V + 1))) over the tokens.

    A null text is an empty one: one token, the end. A null ``held_out`` counts as training. Ids may be null or
    repeated; every row is scored. Where nothing is left to learn from, bytes are equally likely. An empty
    table gives an empty one; other columns are ignored.
    """
    spark = docs.sparkSession
    bits = max(1, (2 * width(spark) - 1).bit_length())
    slim = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out")
    )
    size = slim.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    chunks = max(1, -(-size // chunk_bytes))
    chunked = slim.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)))

    surveyed = slim.mapInArrow(_surveying(bits, order), _REQUEST).groupBy("bucket")
    counts = materialise(surveyed.applyInArrow(_totalling, "bucket long, key long, count long"), "counts")
    is_gram = F.col("bucket") < (1 << bits)
    total = counts.where(~is_gram & (F.col("count") > 0)).agg(F.sum("count").alias("n"), F.count("*").alias("v")).first()
    n, v = total.n or 0, total.v
    words = counts.where(~is_gram).select("bucket", "key", F.col("count").cast("double").alias("value"))
    values = byte_probabilities(counts.where(is_gram), order).union(words)

    asked = chunked.groupBy("chunk").applyInArrow(_asking(bits, order), _REQUEST)
    answers = asked.groupBy("bucket").cogroup(values.groupBy("bucket")).applyInArrow(_answering, _REQUEST)
    scored = (
        chunked.groupBy("chunk")
        .cogroup(answers.groupBy("chunk"))
        .applyInArrow(
            _scoring(bits, order), f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, held_out boolean, n_tokens long, n_known long, words_sum double, score double"
        )
    )
    base = F.col("words_sum") - F.col("n_tokens") * F.log10(F.lit(n + 0.5 * (v + 1)))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), base.alias("base_score"), "score")
