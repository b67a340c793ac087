"""Fixed-size random samples without replacement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalframe.sources.scratch import materialise

_BOUNDS = [0.5**i for i in range(40)]
#: Score ranges that are counted at a time, and scores that are few enough to look at one by one.
_RANGES, _FEW = 1024, 10_000


def sample_score(seed: int = 42, key: Sequence[str] = ()) -> Column:
    """Uniform number in [0, 1): a seeded hash of the row key, or ``rand`` when rows have none.

    With a key the sample is the same on every run and for every file layout.
    """
    if not key:
        return F.rand(seed)
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *[F.col(k) for k in key]), 11)
    return bits / F.lit(float(2**53))


def _kept_per_bound(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows under each power-of-two score bound, as an array ``kept``; partial sums only."""
    kept = [F.count_if(F.col("_score") < b) for b in _BOUNDS]
    return scored.groupBy(*by).agg(F.array(*kept).alias("kept"))


def _tightest(kept: Sequence[int], n: int, keyed: bool) -> float:
    """Smallest score bound that leaves at least ``n`` rows; 1 when there are fewer.

    Scores from ``rand`` may be drawn anew when the data is read again, so they get a margin.
    """
    need = n if keyed else 2 * n + 50
    return min((b for b, k in zip(_BOUNDS, kept) if k >= need), default=1.0)


def score_threshold(scored: DataFrame, n: int) -> tuple[float, int]:
    """(t, m): all rows with a score under t, and m of those with exactly t, are the n rows of smallest score.

    Counts by score range, at most ``_RANGES`` of them on the driver, narrow the range that holds t, until few scores are
    left in it. With fewer than n rows t is 1.
    """
    score = F.col("_score")
    lo, hi, need = 0.0, 1.0, n
    while True:
        step = (hi - lo) / _RANGES  # a power of two, so range limits are exact
        inside = scored.where((score >= lo) & (score < hi))
        at = F.floor((score - F.lit(lo)) / F.lit(step)).cast("int")
        counts = sorted((r[0], r[1]) for r in inside.groupBy(at).count().collect())
        if sum(c for _, c in counts) <= need:
            return hi, 0
        for bucket, count in counts:
            if count > need:
                break
            need -= count
        lo, hi = lo + bucket * step, lo + (bucket + 1) * step
        if count <= _FEW or step <= 2.0**-50:  # scores are whole multiples of 2**-53
            break
    for value, count in sorted((r[0], r[1]) for r in scored.where((score >= lo) & (score < hi)).groupBy("_score").count().collect()):
        if count > need:
            return value, need
        need -= count
    return hi, 0


def sample_rows(
    df: DataFrame, n: int, seed: int = 42, key: Sequence[str] = (), keep_score: bool = False
) -> DataFrame:
    """``n`` random rows, or all rows when there are fewer; exactly the rows of smallest score, in no order.

    The exact score limit is found from counts, so taking the sample is a filter: nothing is sorted, and the
    sample is spread over tasks as its rows are. Without a key a score may be drawn anew when the data is read
    again, so a small multiple of ``n`` rows is written once, and the limit found among those.
    """
    scored = df.withColumn("_score", sample_score(seed, key))
    if not key:
        bound = _tightest(_kept_per_bound(scored).first()["kept"], n, False)
        drawn = materialise(scored.where(F.col("_score") < bound), "sample")
        if bound < 1.0 and drawn.count() < n:
            drawn = materialise(scored, "sample")
        scored = drawn
    limit, ties = score_threshold(scored, n)
    picked = scored.where(F.col("_score") < limit)
    if ties:
        picked = picked.unionByName(scored.where(F.col("_score") == F.lit(limit)).limit(ties))
    return picked if keep_score else picked.drop("_score")


def sample_per_group(
    df: DataFrame,
    by: str,
    groups: Sequence[str],
    n: int,
    seed: int = 42,
    key: Sequence[str] = (),
) -> DataFrame:
    """Up to ``n`` random rows of each listed group.

    As in :func:`sample_rows`, one planning aggregate (a row per listed group) gives each group a
    score bound. Only a small multiple of ``n`` rows per group is shuffled and ranked.
    """
    scored = df.where(F.col(by).isin(*groups)).withColumn(
        "_score", sample_score(seed, [*key, by] if key else ())
    )
    planned = _kept_per_bound(scored, [by]).collect()
    found = {r[by]: _tightest(r["kept"], n, bool(key)) for r in planned}
    bound = F.lit(1.0)
    for group, b in found.items():
        bound = F.when(F.col(by) == group, F.lit(b)).otherwise(bound)
    rank = F.row_number().over(Window.partitionBy(by).orderBy("_score"))
    picked = scored.where(F.col("_score") < bound).withColumn("_rank", rank)
    return picked.where(F.col("_rank") <= n).drop("_rank", "_score")


def first_rows(sampled: DataFrame, n: int) -> DataFrame:
    """First ``n`` rows of a sample that kept its score."""
    return sampled.orderBy("_score").limit(n)
