"""Toxicity by class-conditional Kneser-Ney models of toxic and ordinary texts.

Each class has a word model: counts of its training texts, less a discount, and the discounted mass spread by a
backoff distribution that both classes share: the words' continuation counts, after how many different words a
word was seen. The discount is what the shared counts explain: a word's share of all its occurrences, plus Z standard
deviations; and no count goes above the class's continuation count, so copied texts don't add up. So rare expressions, and any that are about as common in both classes, get the same
backoff probability from both and don't weigh; what a class says significantly more often keeps its surplus.

A text's score is the difference of its two log-likelihoods per word, calibrated to a probability.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalframe.llm.spread import batches
from vitalframe.llm.text import ALNUM, released, slabs

#: Labelled documents per class that the models are fitted to, the first by a digest of their ids.
SAMPLE = 10_000
#: Standard deviations of a word's shared count that are discounted.
Z = 3.0
#: Bytes of text that are counted at a time, and rows that a task hands on at a time.
BATCH_BYTES = 2 << 20
BATCH_ROWS = 50_000

_PAIR = "word long, before long, toxic int, n long"


def _counting(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct (word, word before, class) with counts, a batch at a time."""
    held: list[np.ndarray] = []
    much = 0

    def send() -> pa.Table:
        word, before, toxic = np.concatenate(held, 1)
        order = np.lexsort((toxic, before, word))
        word, before, toxic = word[order], before[order], toxic[order]
        fresh = np.append(True, (word[1:] != word[:-1]) | (before[1:] != before[:-1]) | (toxic[1:] != toxic[:-1]))
        at = np.flatnonzero(fresh)
        n = np.diff(np.append(at, len(word)))
        return pa.Table.from_arrays(
            [pa.array(word[at].view(np.int64)), pa.array(before[at].view(np.int64)), pa.array(toxic[at].astype(np.int32)), pa.array(n)],
            ["word", "before", "toxic", "n"],
        )

    for part in parts:
        toxic = part.column("toxic").to_numpy(zero_copy_only=False)
        for slab in slabs(part.column("text")):
            slab.split(ALNUM)
            h = slab.hashes(lower=True)
            before = np.append(np.uint64(0), h[:-1])[: len(h)]
            before[slab.first[:-1][slab.n_words > 0]] = 0
            owner = np.repeat(toxic[slab.lo : slab.hi], slab.n_words).astype(np.uint64)
            held.append(np.stack([h, before, owner]))
            much += len(slab.data)
            if much >= BATCH_BYTES:
                if any(x.size for x in held):
                    yield from batches(send(), BATCH_ROWS)
                held, much = [], 0
    if any(x.size for x in held):
        yield from batches(send(), BATCH_ROWS)


class WordModels:
    """Per word, how much more likely the toxic model finds it, as a logarithm; one value for all others."""

    def __init__(self, words: np.ndarray, gains: np.ndarray, other: float):
        order = np.argsort(words)
        self.words, self.gains, self.other = words[order], gains[order], other

    def per_word(self, column: pa.Array) -> np.ndarray:
        """Length-normalised log-likelihood ratio of each text; 0 without words."""
        out = np.zeros(len(column))
        for slab in slabs(column):
            slab.split(ALNUM)
            h = slab.hashes(lower=True)
            gain = np.full(len(h), self.other)
            if len(self.words):
                at = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
                gain = np.where(self.words[at] == h, self.gains[at], gain)
            total = np.diff(np.concatenate([[0.0], np.cumsum(gain)])[slab.first])
            out[slab.lo : slab.hi] = total / np.maximum(slab.n_words, 1)
        return out


def word_models(pairs: DataFrame) -> WordModels:
    """Fit both models to (word, before, toxic, n) rows."""
    count = lambda k: F.sum(F.when(F.col("toxic") == k, F.col("n")).otherwise(0))
    kinds = pairs.groupBy("word", "before").agg(count(0).alias("c0"), count(1).alias("c1"))
    words = kinds.groupBy("word").agg(
        *[F.sum(f"c{k}").alias(f"c{k}") for k in (0, 1)],
        *[F.sum((F.col(f"c{k}") > 0).cast("long")).alias(f"kinds{k}") for k in (0, 1)],
        F.count("*").alias("kinds"),
    )
    total = words.agg(F.sum("c0").alias("n0"), F.sum("c1").alias("n1"), F.sum("kinds").alias("kinds")).first()
    if not total.n0 or not total.n1:
        return WordModels(np.zeros(0, np.uint64), np.zeros(0), 0.0)
    n = {0: total.n0, 1: total.n1}

    def surplus(k: int) -> Column:
        shared = (F.col("c0") + F.col("c1")) * F.lit(n[k] / (n[0] + n[1]))
        return F.greatest(F.lit(0.0), F.least(f"c{k}", f"kinds{k}") - shared - Z * F.sqrt(shared + 1))

    kept = words.withColumns({"s0": surplus(0), "s1": surplus(1)}).where("s0 > 0 OR s1 > 0")
    rows = kept.select("word", "s0", "s1", "kinds").toArrow()  # words of the bounded sample that a class says far more often
    word = rows.column("word").to_numpy().view(np.uint64)
    shared = rows.column("kinds").to_numpy() / total.kinds
    logs, others = [], []
    for k in (0, 1):
        s = rows.column(f"s{k}").to_numpy()
        backoff = 1 - s.sum() / n[k]
        logs.append(np.log(s / n[k] + backoff * shared))
        others.append(np.log(backoff))
    return WordModels(word, logs[1] - logs[0], float(others[1] - others[0]))


def calibration(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a ridge logistic regression of y on x."""
    if not len(y) or y.min() == y.max():
        rate = float(np.clip((y * weight).sum() / max(weight.sum(), 1e-9), 0.01, 0.99)) if len(y) else 0.01
        return 0.0, float(np.log(rate / (1 - rate)))
    middle, scale = x.mean(), x.std() or 1.0
    design = np.stack([(x - middle) / scale, np.ones_like(x)], 1)
    b = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ b, -30, 30)))
        ridge = np.array([1e-2, 1e-4])
        gradient = design.T @ (weight * (p - y)) + ridge * b
        curve = (design * (weight * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ design + np.diag(ridge)
        step = np.linalg.solve(curve, gradient)
        b -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(b[0] / scale), float(b[1] - b[0] * middle / scale)


def score_toxicity(
    docs: DataFrame, labels: DataFrame, fit: Column, calibrate: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE
) -> DataFrame:
    """Probability that each text is toxic: all rows and columns of ``docs``, and ``toxicity``.

    ``labels`` has ids and 0/1 labels. ``fit`` and ``calibrate`` are conditions on the id column (of ``labels``) that say
    which labelled rows the models and the calibration learn from; the others are never looked at. At most
    ``sample`` rows per class are used, the first by a digest of their ids; exact copies of a text count once.

    Null and empty texts have no words and get the calibrated score of no evidence. Null labels and ids are
    left out; of several labels of an id the largest counts. With one class only, every text gets that
    class's rate. An empty table gives an empty one.
    """
    spark = docs.sparkSession
    usable = labels.where((fit | calibrate) & F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
    usable = usable.groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("toxic"), F.max(fit).alias("_fit"))
    sizes = {r.toxic: r.n for r in usable.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    order = F.md5(F.col("_id").cast("string"))
    chosen = [usable.where(F.col("toxic") == k).orderBy(order, "_id").limit(sample).toArrow() for k in (0, 1)]
    weights = {k: sizes.get(k, 0) / max(1, min(sizes.get(k, 0), sample)) for k in (0, 1)}
    picked = spark.createDataFrame(pa.concat_tables(chosen))  # from Arrow: a list would take Python workers of its own
    # At most 2 x sample ids: a broadcast of bounded size.
    learn = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(picked), "_id")
    learn = learn.dropDuplicates(["text", "toxic", "_fit"]).select("text", "toxic", "_fit")
    models = word_models(learn.where("_fit").select("text", "toxic").mapInArrow(released(_counting), _PAIR))

    def rating(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            x = pa.array(models.per_word(part.column("text")))
            yield pa.RecordBatch.from_arrays([x, part.column("toxic")], ["x", "toxic"])

    rated = learn.where("NOT _fit").select("text", "toxic").mapInArrow(released(rating), "x double, toxic int").toArrow()
    y = rated.column("toxic").to_numpy()
    slope, offset = calibration(rated.column("x").to_numpy(), y, np.where(y == 1, weights[1], weights[0]))
    shared = spark.sparkContext.broadcast((models, slope, offset))

    def scoring(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models, slope, offset = shared.value
        for part in parts:
            z = slope * models.per_word(part.column(text_col)) + offset
            score = pa.array(1 / (1 + np.exp(-np.clip(z, -500, 500))))
            yield pa.RecordBatch.from_arrays([*part.columns, score], [*part.schema.names, "_toxicity"])

    schema = docs.withColumn("_toxicity", F.lit(0.0)).schema
    return docs.mapInArrow(released(scoring), schema).withColumnRenamed("_toxicity", "toxicity")
