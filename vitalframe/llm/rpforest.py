"""Embedding near-dedup with a forest of random-projection trees.

Each tree splits the space by random projections at the median of a bounded sample, down to small or tight leaves;
vectors within a margin of a split go to both sides (spill). All vectors are routed through all trees, and
vectors that meet in a leaf are compared by exact cosine. Leaves of any size are compared in pairs of bounded
blocks, and a leaf stops splitting where its vectors are mostly near copies of each other, so that large
groups of copies are compared whole.

A pair that meets in several leaves counts in the first one only. Links become counts per vector and a
spanning forest within each block, never rows of pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalframe.llm.spread import components, width
from vitalframe.llm.text import released
from vitalframe.sources.scratch import materialise

TREES = 12
#: Distinct vectors that the trees are fitted to, the first by a digest of their ids.
SAMPLE = 20_000
#: Sampled vectors in a leaf, at most, unless it is tight.
LEAF = 48
#: Share of a node's vectors that both of its sides get.
SPILL = 0.12
#: Mean cosine of a node's vectors from which it isn't split.
TIGHT = 0.7
#: Vectors of a leaf that one block holds.
BLOCK = 2048
#: Leaves whose members are marked at a time to tell which pairs have met before.
MARKED = 256
#: Rows of vectors that a comparing task gets, about.
TASK_ROWS = 20_000


class Forest:
    """Nodes as (direction, threshold, margin, left, right); negative children are leaves, numbered over all trees."""

    def __init__(self, sample: np.ndarray, trees: int = TREES, leaf: int = LEAF, seed: int = 7):
        self.roots: list[int] = []
        self.nodes: list[tuple[np.ndarray, float, float, int, int]] = []
        self.leaves = 0
        rng = np.random.default_rng(seed)
        for _ in range(trees):
            self.roots.append(self._grow(sample, leaf, rng))

    def _leaf(self) -> int:
        self.leaves += 1
        return -self.leaves

    def _grow(self, x: np.ndarray, leaf: int, rng: np.random.Generator) -> int:
        if len(x) <= leaf or (x.mean(0) ** 2).sum() >= TIGHT:
            return self._leaf()
        direction = rng.standard_normal(x.shape[1])
        direction /= np.linalg.norm(direction)
        p = x @ direction
        threshold = float(np.median(p))
        margin = float(np.quantile(np.abs(p - threshold), SPILL))
        left, right = x[p <= threshold + margin], x[p >= threshold - margin]
        if max(len(left), len(right)) == len(x):
            return self._leaf()
        at = len(self.nodes)
        self.nodes.append((direction, threshold, margin, 0, 0))
        self.nodes[at] = (direction, threshold, margin, self._grow(left, leaf, rng), self._grow(right, leaf, rng))
        return at

    def route(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of every leaf that every vector falls in."""
        rows, leaves = [], []
        stack = [(root, np.arange(len(x))) for root in self.roots]
        while stack:
            node, own = stack.pop()
            if node < 0:
                rows.append(own)
                leaves.append(np.full(len(own), -node - 1))
            elif len(own):
                direction, threshold, margin, left, right = self.nodes[node]
                p = x[own] @ direction - threshold
                stack += [(left, own[p <= margin]), (right, own[p >= -margin])]
        return np.concatenate(rows), np.concatenate(leaves)


def _unit(blobs: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(blobs.to_pylist()), np.float64).reshape(len(blobs), -1)


def _parsing(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Unit vectors in double precision as bytes; null where a vector can't link."""
    for part in parts:
        vectors = part.column("vector").cast(pa.list_(pa.float64()))
        flat = vectors.flatten()
        gaps = flat.is_null().to_numpy(zero_copy_only=False)
        values = flat.fill_null(0.0).to_numpy(zero_copy_only=False)
        at, out = 0, []
        for v in vectors:
            n = len(v.values) if v.is_valid else 0
            x, gap = values[at : at + n], gaps[at : at + n].any()
            at += n
            x = x / np.abs(x).max() if n and not gap and np.isfinite(x).all() and x.any() else None
            out.append(None if x is None else (x / np.sqrt(x @ x)).tobytes())
        yield pa.RecordBatch.from_arrays([part.column("vec_id"), pa.array(out, pa.binary())], ["vec_id", "unit"])


def _routing(shared):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest: Forest = shared.value
        for part in parts:
            row, leaf = forest.route(_unit(part.column("unit")))
            order = np.lexsort((leaf, row))
            offsets = np.searchsorted(row[order], np.arange(part.num_rows + 1)).astype(np.int32)
            leaves = pa.ListArray.from_arrays(pa.array(offsets), pa.array(leaf[order].astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*part.columns, leaves], [*part.schema.names, "leaves"])

    return run


def _comparing(least: float):
    """One pair of blocks of a leaf: links per vector, and edges that join what links join."""

    def run(table: pa.Table) -> pa.Table:
        leaf, low, high = (table.column(c)[0].as_py() for c in ("leaf", "low", "high"))
        block, ids, copies = (table.column(c).to_numpy() for c in ("block", "rep", "copies"))
        x = _unit(table.column("unit").combine_chunks())
        a = np.flatnonzero(block == low)
        b = a if low == high else np.flatnonzero(block == high)
        linked = x[a] @ x[b].T >= least
        if low == high:
            np.fill_diagonal(linked, False)
        counted = linked.copy()
        if linked.any():
            p, q = np.flatnonzero(linked.any(1)), np.flatnonzero(linked.any(0))
            links = np.zeros(len(ids), bool)
            links[a[p]] = links[b[q]] = True
            lists = table.column("leaves").combine_chunks()
            owner = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            other = lists.flatten().to_numpy()
            earlier = links[owner] & (other < leaf)
            owner, other = owner[earlier], other[earlier]
            _, at, n = np.unique(other, return_inverse=True, return_counts=True)
            shared = n[at] > 1
            owner, other = owner[shared], other[shared]
            order = np.argsort(other, kind="stable")
            owner, (kinds, at) = owner[order], np.unique(other[order], return_inverse=True)
            apart = np.ones((len(p), len(q)), bool)
            for lo in range(0, len(kinds), MARKED):
                here = slice(*np.searchsorted(at, [lo, lo + MARKED]))
                met = np.zeros((len(ids), MARKED), np.float32)
                met[owner[here], at[here] - lo] = 1
                apart &= met[a[p]] @ met[b[q]].T == 0
            counted[np.ix_(p, q)] &= apart
        degree = np.zeros(len(ids), np.int64)
        degree[a] += counted @ copies[b]
        if low != high:
            degree[b] += copies[a] @ counted
        label = np.arange(len(ids))
        while True:
            near = label.copy()
            toward = np.where(linked, label[b], len(ids)).min(1, initial=len(ids))
            near[a] = np.minimum(near[a], toward)
            back = np.where(linked, label[a][:, None], len(ids)).min(0, initial=len(ids))
            near[b] = np.minimum(near[b], back)
            if (near == label).all():
                break
            label = near
        told = (degree > 0) | (label != np.arange(len(ids)))
        return pa.table({"rep": ids[told], "degree": degree[told], "root": ids[label[told]]})

    return run


def near_vectors(
    vectors: DataFrame, least: float, id_col: str = "vec_id", vector_col: str = "embedding", trees: int = TREES, sample: int = SAMPLE, leaf: int = LEAF
) -> DataFrame:
    """Links and components of vectors with a cosine of ``least`` or more, found by the forest.

    Returns one row per row of ``vectors``: (vec_id, n_links, component_id, kept): how many other vectors were
    found to link with it directly, the smallest id that links reach, and whether that is its own. No pair below ``least``
    links; recall depends on ``trees``, ``leaf`` and the spill. Exactly equal vectors are always linked.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, nor do rows with a
    null id. Vectors of different lengths don't link. Rows equal in id and vector are one vector, each returned. An
    empty table gives an empty one; other columns are ignored.
    """
    spark = vectors.sparkSession
    slim = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    parsed = slim.mapInArrow(released(_parsing), "vec_id long, unit binary").withColumn("unit", F.when(F.col("vec_id").isNotNull(), F.col("unit")))
    classes = parsed.where("unit IS NOT NULL").groupBy("unit").agg(F.min("vec_id").alias("rep"), F.countDistinct("vec_id").alias("copies"))
    classes = materialise(classes, "vectors")
    known = materialise(
        parsed.join(classes, "unit", "left").select("vec_id", F.coalesce("rep", "vec_id").alias("rep"), F.coalesce("copies", F.lit(1)).alias("copies")), "ids"
    )
    sizes = [r.n for r in classes.groupBy(F.octet_length("unit").alias("n")).count().collect()]  # the lengths of vectors
    degrees = edges = None
    for n in sorted(sizes):
        here = classes.where(F.octet_length("unit") == n)
        first = here.orderBy(F.md5(F.col("rep").cast("string")), "rep").limit(sample).select("unit").toArrow()  # bounded by `sample`
        forest = Forest(_unit(first.column("unit").combine_chunks()), trees, leaf)
        shared = spark.sparkContext.broadcast(forest)
        routed = here.mapInArrow(released(_routing(shared)), "unit binary, rep long, copies long, leaves array<int>")
        routed = materialise(routed, "routed")
        blocks = routed.select(F.explode("leaves").alias("leaf")).groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"), F.count("*").alias("n"))
        blocks = materialise(blocks, "blocks")
        rows = routed.select("unit", "rep", "copies", F.posexplode("leaves").alias("before", "leaf"), "leaves").join(blocks.drop("n"), "leaf")
        # Only the leaves before this one tell where a pair has met; they ascend.
        rows = rows.withColumn("leaves", F.slice("leaves", F.lit(1), F.col("before"))).drop("before")
        rows = rows.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")))
        rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        rows = rows.withColumns({"low": F.least("block", "with"), "high": F.greatest("block", "with")}).drop("with")
        sent = blocks.agg(F.sum(F.col("n") * F.col("blocks"))).first()[0]
        parts = max(width(spark), -(-sent // TASK_ROWS))
        # Neighbouring leaves share vectors, which take little room in one place; leaves of several blocks are spread.
        near = F.floor(F.col("leaf") * F.lit(float(parts)) / forest.leaves)
        rows = rows.withColumn("place", F.when(F.col("blocks") > 1, F.xxhash64("leaf", "low", "high")).otherwise(near)).drop("blocks")
        rows = rows.repartition(parts, "place")
        found = materialise(
            rows.groupBy("place", "leaf", "low", "high").applyInArrow(_comparing(least), "rep long, degree long, root long"), "found"
        )
        degrees = found if degrees is None else degrees.union(found)
    if degrees is None:
        return known.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("rep").alias("component_id"), F.lit(True).alias("kept"))
    edges = degrees.select(F.col("rep").alias("a"), F.col("root").alias("b")).where("a <> b").distinct()
    degrees = degrees.groupBy("rep").agg(F.sum("degree").alias("degree"))
    joined = known.join(degrees, "rep", "left").join(components(edges).withColumnRenamed("node", "rep"), "rep", "left")
    component = F.coalesce("component", "rep")
    return joined.select(
        "vec_id",
        (F.coalesce("degree", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"),
    )
