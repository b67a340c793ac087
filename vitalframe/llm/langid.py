"""Language identification with a bit-sliced Bloom filter of n-grams.

Every language's characteristic n-grams go into one Bloom filter whose rows hold one bit per language: the AND of an
n-gram's rows is the set of all languages that contain it. Per text and language, the hits are counted, corrected
for the filter's false positives (its share of set bits to the power of the number of hashes), and the largest
count decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalframe.llm.text import ALNUM, LOWER, Slab, mixed, slabs

#: Lengths of the n-grams in bytes.
LENGTHS = (3, 4)
#: An n-gram belongs to a language if it is at least this share of its n-grams of that length; so a
#: language has at most len(LENGTHS) / SHARE n-grams, however much text there is.
SHARE = 5e-6
#: ... and at least this share of what it is in the language where it is most common.
PART = 0.05
#: log2 of the filter's rows, and hashes per n-gram.
ROWS, HASHES = 22, 2
BATCH_BYTES = 4 << 20
UNKNOWN = "und"


def grams(slab: Slab, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Packed n-grams of lower-cased bytes that hold a letter, a text at a time, spaces around each text."""
    lengths = np.diff(slab.offsets)
    padded = np.full(len(slab.data) + 2 * len(lengths), 0x20, np.uint8)
    padded[np.arange(len(slab.data)) + np.repeat(2 * np.arange(len(lengths)) + 1, lengths)] = LOWER[slab.data]
    starts = slab.offsets[:-1] + 2 * np.arange(len(lengths))
    counts = np.maximum(lengths + 2 - n + 1, 0)
    owner = np.repeat(np.arange(len(lengths)), counts)
    at = np.arange(counts.sum()) + np.repeat(starts - np.cumsum(counts) + counts, counts)
    code = np.full(len(at), n - LENGTHS[0] + 1, np.uint64)
    letters = np.zeros(len(at), bool)
    letter = ALNUM.copy()
    letter[0x30:0x3A] = False
    for i in range(n):
        byte = padded[at + i]
        code = (code << np.uint64(8)) | byte.astype(np.uint64)
        letters |= letter[byte]
    return code[letters], owner[letters]


def _counting(langs: list[str]):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        much = 0

        def send() -> pa.RecordBatch:
            both = np.sort(np.concatenate(held))
            at = np.flatnonzero(np.append(True, both[1:] != both[:-1]))
            n = np.diff(np.append(at, len(both)))
            lang = (both[at] >> np.uint64(40)).astype(np.int32)
            return pa.RecordBatch.from_arrays(
                [pa.array((both[at] & np.uint64((1 << 40) - 1)).view(np.int64)), pa.array(lang), pa.array(n)], ["gram", "lang", "n"]
            )

        number = {x: i for i, x in enumerate(langs)}
        for part in parts:
            lang = np.array([number[x] for x in part.column("lang").to_pylist()], np.uint64)
            for slab in slabs(part.column("text")):
                for n in LENGTHS:
                    code, owner = grams(slab, n)
                    held.append(code | (lang[slab.lo : slab.hi][owner] << np.uint64(40)))
                much += len(slab.data)
                if much >= BATCH_BYTES:
                    if any(map(len, held)):
                        yield send()
                    held, much = [], 0
        if any(map(len, held)):
            yield send()

    return run


class SlicedBloom:
    """One row of bits per hash value, one bit per language."""

    def __init__(self, langs: list[str], gram: np.ndarray, lang: np.ndarray, commonest: int):
        self.langs, self.commonest = langs, commonest
        self.words = max(1, -(-len(langs) // 64))
        self.rows = np.zeros((1 << ROWS, self.words), np.uint64)
        for row in self._at(gram.astype(np.uint64)):
            np.bitwise_or.at(self.rows, (row, lang // 64), np.uint64(1) << (lang % 64).astype(np.uint64))
        fill = np.array([(self.rows[:, i // 64] >> np.uint64(i % 64) & np.uint64(1)).mean() for i in range(len(langs))])
        self.false = fill**HASHES

    @staticmethod
    def _at(gram: np.ndarray) -> list[np.ndarray]:
        h = mixed(gram)
        return [(h >> np.uint64(i * 32) & np.uint64((1 << ROWS) - 1)).astype(np.int64) for i in range(HASHES)]

    def masks(self, gram: np.ndarray) -> np.ndarray:
        out = np.full((len(gram), self.words), ~np.uint64(0))
        for row in self._at(gram):
            out &= self.rows[row]
        return out

    def counts(self, slab: Slab) -> np.ndarray:
        """Texts x languages: n-grams found, less the false positives to be expected."""
        n_texts = slab.hi - slab.lo
        hits, total = np.zeros((n_texts, len(self.langs))), np.zeros(n_texts)
        for n in LENGTHS:
            code, owner = grams(slab, n)
            masks = self.masks(code)
            total += np.bincount(owner, minlength=n_texts)
            for i in range(len(self.langs)):
                found = masks[:, i // 64] & (np.uint64(1) << np.uint64(i % 64)) != 0
                hits[:, i] += np.bincount(owner[found], minlength=n_texts)
        return np.maximum(hits - total[:, None] * self.false, 0) / (1 - self.false)


def _has_letter(slab: Slab) -> np.ndarray:
    low = LOWER[slab.data]
    ascii_letters = np.concatenate([[0], np.cumsum((low >= 0x61) & (low <= 0x7A))])
    out = np.diff(ascii_letters[slab.offsets]) > 0
    wide = np.concatenate([[0], np.cumsum(slab.data >= 0x80)])
    for i in np.flatnonzero(~out & (np.diff(wide[slab.offsets]) > 0)):
        out[i] = any(map(str.isalpha, slab.text(i).decode()))
    return out


def learn_filter(docs: DataFrame, learn: Column, text_col: str = "text", lang_col: str = "lang") -> SlicedBloom:
    """Fit the filter to the texts with a language among the rows where ``learn`` holds; n-grams are counted over all."""
    rows = docs.where(learn & F.col(lang_col).isNotNull()).select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).alias("lang"))
    known = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy("lang").collect()  # a row a language
    langs = [r.lang for r in known]
    counted = rows.mapInArrow(_counting(langs), "gram long, lang int, n long").groupBy("gram", "lang").agg(F.sum("n").alias("n"))
    counted = counted.withColumn("length", (F.shiftright("gram", 24) > 255).cast("int"))
    sizes = {(r.lang, r.length): r.n for r in counted.groupBy("lang", "length").agg(F.sum("n").alias("n")).collect()}
    if not sizes:
        return SlicedBloom(langs, np.zeros(0, np.uint64), np.zeros(0, np.int64), 0)
    whole = F.create_map(*[F.lit(x) for (lang, length), n in sizes.items() for x in (f"{lang} {length}", float(n))])
    share = counted.withColumn("share", F.col("n") / whole[F.concat_ws(" ", F.col("lang").cast("string"), F.col("length").cast("string"))])
    most = share.groupBy("gram").agg(F.max("share").alias("most"), F.collect_list(F.struct("lang", "share")).alias("all"))  # a struct a language
    kept = most.select("gram", "most", F.explode("all").alias("x")).where((F.col("x.share") >= SHARE) & (F.col("x.share") >= PART * F.col("most")))
    table = kept.select("gram", F.col("x.lang").alias("lang")).toArrow()  # bounded by SHARE
    commonest = max(range(len(langs)), key=lambda i: (known[i].n, -i))
    return SlicedBloom(langs, table.column("gram").to_numpy(), table.column("lang").to_numpy().astype(np.int64), commonest)


def identify(docs: DataFrame, bloom: SlicedBloom, text_col: str = "text") -> DataFrame:
    """The most likely language of every text: all rows and columns of ``docs``, and ``lang_pred``, ``lang_score``.

    A text that is null or has no letter is `und` with score 0, as is every text if no language was learnt. A text
    without known n-grams gets the commonest language with score 0. Otherwise the score is the winner's share of all
    languages' corrected hits. Ties go to the language that sorts first. An empty table gives an empty one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(bloom)  # 2**ROWS rows, whatever the input

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bloom: SlicedBloom = shared.value
        for part in parts:
            names, scores = [], []
            for slab in slabs(part.column(text_col)):
                letter = _has_letter(slab)
                if not bloom.langs:
                    names += [UNKNOWN] * len(letter)
                    scores.append(np.zeros(len(letter)))
                    continue
                counts = bloom.counts(slab)
                best, total = counts.argmax(1), counts.sum(1)
                best = np.where(total > 0, best, bloom.commonest)
                score = np.where(letter & (total > 0), counts.max(1) / np.maximum(total, 1e-9), 0.0)
                names += [bloom.langs[i] if ok else UNKNOWN for i, ok in zip(best, letter)]
                scores.append(score)
            score = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(names, pa.string()), pa.array(score)], [*part.schema.names, "_lang", "_score"])

    schema = docs.withColumns({"_lang": F.lit(""), "_score": F.lit(0.0)}).schema
    return docs.mapInArrow(run, schema).withColumnsRenamed({"_lang": "lang_pred", "_score": "lang_score"})
