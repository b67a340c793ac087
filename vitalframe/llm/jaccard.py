"""N-gram Jaccard self-join by PartEnum signatures.

Sets whose sizes allow a Jaccard of t differ in at most k elements, k following from the larger size. Sizes are
cut into bands; within a band the feature domain is cut into n1 parts, each into n2 smaller ones. Two sets that
differ in k elements differ in at most k2 elements in one of the n1 parts, so there they agree on some subset of
n2 - k2 smaller parts: the contents of every such subset are a signature, and linked sets share one.
A few parts more than needed are cut (the slack), so that agreeing on empty parts never is the only agreement.

Documents that share a signature are candidates, which the words themselves verify:

1. exact copies are one class; only class representatives go on;
2. in every signature's group, each member is verified against the smallest one, and links join components;
3. groups that still hold several components compare their members in blocks: those outside the largest component
   verify their nearest partners first, then more, at last all that are left, so that few pairs are needed where
   one member links many. Members that share many groups meet in the first of them.

Before any texts meet, sketches of the sets give a bound on the difference that leaves out most pairs.

So no group of copies is ever expanded into its pairs, and no link between components is missed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalframe.llm.spread import among, arrow_rows, components, few, width
from vitalframe.llm.text import LOWER, SPACED, mixed, released, slabs
from vitalframe.sources.scratch import materialise

#: Size of a band's largest set over its smallest.
BAND = 1.25
#: Elements that a signature of a band's smallest set should have on average.
DENSE = 4
#: Bytes of text whose signatures travel as one blob per bucket.
BATCH_BYTES = 4 << 20
#: Bytes that the cells and the signatures of the texts signed at a time may take, and records sent on at a time.
SLICE_BYTES, SEND_RECORDS = 8 << 20, 1 << 19
#: Rows with texts that a Python task takes at a time.
ARROW_ROWS = 1000
#: Members of a group that one block holds.
BLOCK = 1000
#: Partners that a member of a group of several components meets at most, round by round; at last all.
NEAREST = (4, 64, None)
#: Groups, the first in order, that a member carries along to tell in which one it meets another. With fewer, more pairs
#: come from several groups; none is left out.
CARRIED = 16

RECORD = np.dtype([("sig", "<u8"), ("doc", "<i8")])
#: Low bytes of a signature that travel. Unlike sets that agree in them are candidates that verification rejects.
SIG_BYTES = 6


@dataclass(frozen=True)
class Band:
    """How the sets of one band are cut."""

    index: int
    low: int
    high: int
    n1: int
    n2: int
    k2: int
    slack: int

    @property
    def subsets(self) -> list[tuple[int, ...]]:
        return list(combinations(range(self.n2), self.n2 - self.k2))


def bands(largest: int, percent: int) -> list[Band]:
    """Bands up to the given set size."""
    out, low = [], 1
    while low <= largest:
        high = max(low, int(np.ceil(low * BAND)) - 1)
        k = 2 * high * (100 - percent) // (100 + percent)
        ways = []
        for k2, n2 in [(k2, n2) for k2 in range(min(k, 1), min(k, 3) + 1) for n2 in range(k2 + 1, k2 + 5)]:
            need = k // (k2 + 1) + 1
            empty = need * comb(n2, k2) * np.exp(-low * (n2 - k2) / (need * n2))
            slack = int(np.ceil(empty + 4 * np.sqrt(empty))) if need > 1 else 0
            dense = low * (n2 - k2) / ((need + slack) * n2)
            ways.append((dense < DENSE, (need + slack) * comb(n2, k2) if dense >= DENSE else -dense, need + slack, n2, k2, slack))
        _, _, n1, n2, k2, slack = min(ways)
        out.append(Band(len(out), low, high, n1, n2, k2, slack))
        low = high + 1
    return out


def shingle_sets(column: pa.Array, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """By slab: lo, hi, and the distinct shingles as (text index from lo, hash), sorted."""
    for slab in slabs(column):
        slab.data = LOWER[slab.data]
        slab.split(SPACED)
        _, owner, h = slab.windows(slab.hashes(), k, short=True)
        order = np.lexsort((h, owner))
        owner, h = owner[order], h[order]
        if len(h):
            fresh = np.append(True, (h[1:] != h[:-1]) | (owner[1:] != owner[:-1]))
            owner, h = owner[fresh], h[fresh]
        yield slab.lo, slab.hi, owner, h


def _sums(owner: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, np.uint64)
    np.add.at(out, owner, h)
    return out


def _sketches(owner: np.ndarray, h: np.ndarray, size: np.ndarray) -> pa.Array:
    """A byte per cell and set, a set of n shingles having n / 2 to n cells, a power of two, 8 at least.

    A cell adds up a byte of each of its shingles' hashes, so cells that differ hold different shingles, and
    a sketch folds to half its cells by adding its halves.
    """
    cells = np.maximum(8, 1 << np.ceil(np.log2(np.maximum(size, 1))).astype(np.int64) >> 1)
    base = np.concatenate([[0], np.cumsum(cells)])
    x = mixed(h ^ np.uint64(5))
    at = base[owner] + (x & (cells[owner] - 1).astype(np.uint64)).astype(np.int64)
    marks = np.zeros(base[-1], np.uint8)
    np.add.at(marks, at, (x >> np.uint64(40)).astype(np.uint8))
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(base), pa.py_buffer(marks)]).cast(pa.binary())


def _folded(sketch: np.ndarray, cells: int) -> np.ndarray:
    while len(sketch) > cells:
        sketch = sketch[: len(sketch) // 2] + sketch[len(sketch) // 2 :]
    return sketch


def _profiling(k: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for lo, hi, owner, h in shingle_sets(part.column("text"), k):
                n = hi - lo
                size = np.bincount(owner, minlength=n)
                prints = [_sums(owner, mixed(h ^ np.uint64(salt)), n).view(np.int64) for salt in (1, 2)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").slice(lo, n), pa.array(size), *map(pa.array, prints), _sketches(owner, h, size)],
                    ["doc_id", "n_shingles", "print1", "print2", "marks"],
                )

    return run


def _signatures(band: Band, row: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of n sets cut as the band says: row and signature of each."""
    x = mixed(h ^ np.uint64(band.index + 11))
    cell = (x % np.uint64(band.n1)).astype(np.int64) * band.n2 + ((x >> np.uint64(40)) % np.uint64(band.n2)).astype(np.int64)
    at = row * (band.n1 * band.n2) + cell
    sums = _sums(at, mixed(h), n * band.n1 * band.n2).reshape(n, band.n1, band.n2)
    counts = np.bincount(at, minlength=n * band.n1 * band.n2).reshape(n, band.n1, band.n2)
    sigs = np.stack([sums[:, :, s].sum(2) for s in map(list, band.subsets)], 2)
    empty = np.stack([counts[:, :, s].sum(2) == 0 for s in map(list, band.subsets)], 2)
    many = empty.any(2).sum(1) > band.slack
    salt = mixed(np.arange(sigs[0].size, dtype=np.uint64) + np.uint64(1 + (band.index << 32))).reshape(sigs.shape[1:])
    shown = ~empty | many[:, None, None]
    rows = np.broadcast_to(np.arange(n)[:, None, None], sigs.shape)[shown]
    return rows, mixed(sigs + salt)[shown]


def _planes(records: np.ndarray) -> bytes:
    """Records byte by byte: all first bytes, all second ones, ...; what ids share compresses then.

    Of a signature SIG_BYTES stay, besides the bits that name the bucket.
    """
    sig, doc = (np.ascontiguousarray(records[c]).view(np.uint8).reshape(-1, 8).T for c in ("sig", "doc"))
    return sig[:SIG_BYTES].tobytes() + doc.tobytes()


def _records(blob: bytes) -> np.ndarray:
    """What `_planes` packed."""
    planes = np.frombuffer(blob, np.uint8).reshape(SIG_BYTES + 8, -1)
    out = np.zeros((planes.shape[1], 2, 8), np.uint8)
    out[:, 0, :SIG_BYTES] = planes[:SIG_BYTES].T
    out[:, 1] = planes[SIG_BYTES:].T
    return out.reshape(-1).view(RECORD)


def _signing(k: int, percent: int, bits: int):
    def send(held: list) -> Iterator[pa.RecordBatch]:
        doc, size, prints = (np.concatenate([x[i] for x in held]) for i in range(3))
        row = np.concatenate([x[3] + base for x, base in zip(held, np.cumsum([0, *[len(x[0]) for x in held]]))])
        h = np.concatenate([x[4] for x in held])
        # Of exact copies in the batch, the smallest id signs for all.
        order = np.lexsort((doc, prints))
        first = np.append(True, prints[order][1:] != prints[order][:-1])
        signs = np.zeros(len(doc), bool)
        signs[order[first]] = True
        signs &= size > 0
        plan = bands(int(size.max(initial=1)) * 2, percent)
        lows = np.array([b.low for b in plan])
        own = np.searchsorted(lows, size, "right") - 1
        reach = np.searchsorted(lows, size * 100 // percent, "right") - 1
        records, many = [], 0
        for band in plan:
            if band.high * (100 - percent) * 2 < 100 + percent:
                continue  # here linked sets are equal
            mine = np.flatnonzero(signs & (own <= band.index) & (reach >= band.index))
            step = max(1, SLICE_BYTES // (8 * band.n1 * (band.n2 + len(band.subsets))))
            for some in (mine[lo : lo + step] for lo in range(0, len(mine), step)):
                index = np.full(len(doc), -1)
                index[some] = np.arange(len(some))
                here = slice(*np.searchsorted(row, [some[0], some[-1] + 1]))
                at = index[row[here]]
                picked = at >= 0
                rows, sigs = _signatures(band, at[picked], h[here][picked], len(some))
                out = np.empty(len(rows), RECORD)
                out["sig"], out["doc"] = sigs, doc[some][rows]
                records.append(out)
                many += len(out)
                if many >= SEND_RECORDS:
                    yield packed(records)
                    records, many = [], 0
        if records:
            yield packed(records)

    def packed(records: list[np.ndarray]) -> pa.RecordBatch:
        """A row per bucket with its records."""
        found = np.concatenate(records)
        bucket = (found["sig"] >> np.uint64(64 - bits)).astype(np.int64)
        order = np.lexsort((found["doc"], bucket))
        kinds, at = np.unique(bucket[order], return_index=True)
        found = found[order]
        blobs = [_planes(found[a:b]) for a, b in zip(at, [*at[1:], len(found)])]
        return pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(blobs, pa.binary())], ["bucket", "blob"])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, much = [], 0
        for part in parts:
            ids = part.column("doc_id").to_numpy(zero_copy_only=False)
            for lo, hi, owner, h in shingle_sets(part.column("text"), k):
                held.append((ids[lo:hi], np.bincount(owner, minlength=hi - lo), _sums(owner, mixed(h ^ np.uint64(1)), hi - lo), owner, h))
                much += len(h) * 8
                if much >= BATCH_BYTES:
                    yield from send(held)
                    held, much = [], 0
        if held:
            yield from send(held)

    return run


def _grouping(table: pa.Table) -> pa.Table:
    """One bucket: the groups of two or more documents that share a signature, equal groups once."""
    records = np.concatenate([_records(b.as_buffer()) for b in table.column("blob")])
    records = records[np.lexsort((records["doc"], records["sig"]))]
    sig, doc = records["sig"], records["doc"]
    fresh = np.append(True, (sig[1:] != sig[:-1]) | (doc[1:] != doc[:-1]))
    sig, doc = sig[fresh], doc[fresh]
    start = np.flatnonzero(np.append(True, sig[1:] != sig[:-1]))
    length = np.diff(np.append(start, len(sig)))
    whole = _sums(np.repeat(np.arange(len(start)), length), mixed(doc.view(np.uint64)), len(start))
    _, once = np.unique(whole, return_index=True)
    keep = np.zeros(len(start), bool)
    keep[once] = True
    keep &= length > 1
    shown = np.repeat(keep, length)
    return pa.table({"grp": np.repeat(sig[start].view(np.int64), length)[shown], "doc": doc[shown]})


def _verifying(k: int, percent: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for lo in range(0, part.num_rows, 256):
                rows = part.slice(lo, 256)
                n = rows.num_rows
                found = []
                for side in ("text_a", "text_b"):
                    sets = [(owner + at, h) for at, _, owner, h in shingle_sets(rows.column(side), k)]
                    found.append(tuple(map(np.concatenate, zip(*sets))))
                (oa, ha), (ob, hb) = found
                owner, h = np.concatenate([oa, ob]), np.concatenate([ha, hb])
                order = np.lexsort((h, owner))
                owner, h = owner[order], h[order]
                both = owner[1:][(owner[1:] == owner[:-1]) & (h[1:] == h[:-1])]
                common = np.bincount(both, minlength=n)
                union = np.bincount(oa, minlength=n) + np.bincount(ob, minlength=n) - common
                linked = (100 * common >= percent * union) & (union > 0)
                yield pa.RecordBatch.from_arrays(
                    [x.filter(pa.array(linked)) for x in (rows.column("a"), rows.column("b"))], ["a", "b"]
                )

    return run


def _bounding(percent: int):
    """Pairs whose sketches don't rule out that they link: cells that differ are so many shingles at least."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            both = np.asarray(part.column("n_a")) + np.asarray(part.column("n_b"))
            differ = np.zeros(part.num_rows, np.int64)
            for i, pair in enumerate(zip(part.column("marks_a"), part.column("marks_b"))):
                a, b = (np.frombuffer(x.as_buffer(), np.uint8) for x in pair)
                cells = min(len(a), len(b))
                differ[i] = np.count_nonzero(_folded(a, cells) != _folded(b, cells))
            near = pa.array((both - differ) * (100 + percent) >= 2 * percent * both)
            yield pa.RecordBatch.from_arrays([part.column(c).filter(near) for c in "ab"], ["a", "b"])

    return run


def _comparing(percent: int, keep: int | None):
    """One pair of blocks of a group: pairs from different components that the bound can't rule out; ``cut`` if there are more.

    Members of the largest component here wait for the others, each of which takes its ``keep`` nearest partners. Of two
    members from different components one is outside the largest, so in the last round, without ``keep``, no pair is left out.

    ``groups`` holds the first groups of each member in ascending order. A pair is passed over if both name a group that
    comes before this one, for they meet there as well. In the first group that they share they always meet.
    """

    def run(table: pa.Table) -> pa.Table:
        doc, component, n, block = (table.column(c).to_numpy() for c in ("doc", "component", "n", "block"))
        held = [np.frombuffer(x, np.uint8) for x in table.column("marks").to_pylist()]
        marks = np.stack([_folded(x, min(map(len, held))) for x in held])
        kinds, sizes = np.unique(component, return_counts=True)
        waits = component == kinds[sizes.argmax()]
        low, high = (table.column(c)[0].as_py() for c in ("low", "high"))
        grp = table.column("grp")[0].as_py()
        earlier = np.full((len(doc), CARRIED), grp)
        if "groups" in table.column_names:
            names = table.column("groups").combine_chunks()
            many = np.diff(names.offsets.to_numpy())
            place = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            earlier[np.repeat(np.arange(len(doc)), many), place] = np.minimum(names.flatten().to_numpy(), grp)
        left, right = block == low, block == high
        sides = [(left, right)] if low == high else [(left, right), (right, left & waits)]
        a, b, cut = [], [], False
        for own, others in sides:
            others = np.flatnonzero(others)
            for i in np.flatnonzero(own & ~waits):
                differ = (marks[others] != marks[i]).sum(1)
                both = n[others] + n[i]
                near = ((both - differ) * (100 + percent) >= 2 * percent * both) & (component[others] != component[i])
                chosen = np.flatnonzero(near)
                before = earlier[i][earlier[i] < grp]
                if len(before):
                    chosen = chosen[~np.isin(earlier[others[chosen]], before).any(1)]
                if keep is not None and len(chosen) > keep:
                    cut = True
                    chosen = chosen[np.argsort(differ[chosen] / both[chosen], kind="stable")[:keep]]
                a.append(np.full(len(chosen), doc[i]))
                b.append(doc[others[chosen]])
        a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, b))
        a, b = np.minimum(a, b), np.maximum(a, b)
        if len(a):
            a, b = np.unique(np.stack([a, b]), axis=1)
        return pa.table({"grp": np.full(len(a), grp), "a": a, "b": b, "cut": np.full(len(a), cut)})

    return run


def near_copies(
    docs: DataFrame, k: int, percent: int, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None
) -> DataFrame:
    """Components of documents whose sets of ``k``-word shingles have a Jaccard of ``percent`` / 100 or more.

    Words are runs of other than white space, A-Z lower-cased; a text of fewer words is one shingle. Returns one
    row per row of ``docs``: (doc_id, n_shingles, component_id), the smallest id that links reach.

    Null and empty texts have no shingles and link with nothing, nor do rows with a null id (their component is
    null). Rows with the same id are one node with several texts. An empty table gives an empty one; other columns are
    ignored. ``buckets`` (a power of two; by default twice the shuffle width or more) sets how many parts the
    signatures are grouped in.
    """
    with arrow_rows(docs.sparkSession, ARROW_ROWS):
        return _near_copies(docs, k, percent, id_col, text_col, buckets)


def _near_copies(docs: DataFrame, k: int, percent: int, id_col: str, text_col: str, buckets: int | None) -> DataFrame:
    """All of the Python work is done, and written, when this returns."""
    spark = docs.sparkSession
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    bits = max(1, ((buckets or 2 * width(spark)) - 1).bit_length())

    schema = "doc_id long, n_shingles long, print1 long, print2 long, marks binary"
    profile = materialise(slim.mapInArrow(released(_profiling(k)), schema), "profile")
    prints = ["n_shingles", "print1", "print2"]
    classes = profile.where("n_shingles > 0").groupBy(*prints).agg(F.min("doc_id").alias("_rep"))
    known = profile.join(classes, prints, "left").select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("_rep", "doc_id")).alias("rep"))
    known = materialise(few(known), "classes")

    signed = slim.where("doc_id IS NOT NULL").mapInArrow(released(_signing(k, percent, bits)), "bucket long, blob binary")
    groups = signed.groupBy("bucket").applyInArrow(_grouping, "grp long, doc long")
    reps = known.where("n_shingles > 0").select(F.col("doc_id").alias("doc"), "rep", F.col("n_shingles").alias("n")).distinct()
    members = materialise(few(groups.join(reps, "doc").select("grp", F.col("rep").alias("doc"), "n").distinct()), "groups")
    firsts = members.groupBy("grp").agg(F.min("doc").alias("first"), F.min_by("n", "doc").alias("first_n"), F.count("*").alias("size")).where("size > 1")
    fits = 100 * F.least("n", "first_n") >= percent * F.greatest("n", "first_n")
    star = members.join(firsts, "grp").where((F.col("doc") != F.col("first")) & fits).select(F.col("first").alias("a"), F.col("doc").alias("b")).distinct()
    star = materialise(few(star), "pairs")

    sketch = profile.where("n_shingles > 0 AND doc_id IS NOT NULL").select(F.col("doc_id").alias("doc"), F.col("n_shingles").alias("n"), "marks")

    def plausible(pairs: DataFrame) -> DataFrame:
        for x in "ab":
            side = sketch.select(F.col("doc").alias(x), F.col("n").alias(f"n_{x}"), F.col("marks").alias(f"marks_{x}"))
            pairs = pairs.hint("merge").join(side, x)
        return pairs.mapInArrow(released(_bounding(percent)), "a long, b long").distinct()

    def verified(pairs: DataFrame) -> DataFrame:
        # Texts meet pairs by shuffle at every size: how many documents have candidates isn't bounded. Most other texts stay behind.
        involved = pairs.select(F.explode(F.array("a", "b")).alias("doc")).distinct()
        texts = materialise(among(slim, "doc_id", involved).join(involved.hint("merge"), F.col("doc_id") == F.col("doc")).select("doc", "text"), "texts")
        with_b = pairs.hint("merge").join(texts.select(F.col("doc").alias("b"), F.col("text").alias("text_b")), "b")
        with_a = with_b.hint("merge").join(texts.select(F.col("doc").alias("a"), F.col("text").alias("text_a")), "a")
        return with_a.select("a", "b", "text_a", "text_b").mapInArrow(released(_verifying(k, percent)), "a long, b long").distinct()

    star = materialise(few(plausible(star)), "pairs")

    # Two texts under one id are one node: their classes are linked.
    several = known.where("n_shingles > 0").groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a <> b")
    same = known.where("n_shingles > 0").join(several.select("doc_id", "a"), "doc_id").select("a", F.col("rep").alias("b")).where("a <> b")
    # Each member meets its smallest partner first; of the other pairs, those that are then connected need no texts.
    near = materialise(few(star.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")), "pairs")
    links = materialise(few(verified(near).union(same)), "links")
    found = components(links)
    of_a, of_b = (found.select(F.col("node").alias(x), F.col("component").alias(f"c{x}")) for x in "ab")
    apart = star.join(near, ["a", "b"], "left_anti").join(of_a, "a", "left").join(of_b, "b", "left")
    apart = materialise(few(apart.where("NOT coalesce(ca, a) <=> coalesce(cb, b)").select("a", "b")), "pairs")
    if apart.limit(1).count():
        links = links.union(materialise(few(verified(apart)), "links"))
        found = components(links)

    # Groups that still hold several components: each member outside the largest meets its nearest few; where it has more, then more, at last all.
    tried, active = star, members.select("grp").distinct()
    for keep in NEAREST:
        rest = members.join(active, "grp", "left_semi").join(found, members.doc == found.node, "left")
        rest = rest.select("grp", "doc", F.coalesce("component", "doc").alias("component"))
        mixed_groups = rest.groupBy("grp").agg(
            F.count("*").alias("size"), F.min("component").alias("c0"), F.max("component").alias("c1")
        ).where("size > 2 AND c0 <> c1").select("grp", F.ceil(F.col("size") / BLOCK).alias("blocks"))
        rest = materialise(few(rest.distinct().join(mixed_groups, "grp")), "rest")
        if not rest.limit(1).count():
            break
        first = rest.groupBy("doc").agg(F.slice(F.sort_array(F.collect_list("grp")), 1, CARRIED).alias("groups"))
        rows = rest.join(first.join(sketch, "doc"), "doc").withColumn("block", F.pmod(F.xxhash64("doc"), F.col("blocks")))
        rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        rows = rows.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
        blocks = rows.select("grp", "low", "high", "block", "doc", "component", "n", "marks", "groups").groupBy("grp", "low", "high")
        pairs = materialise(blocks.applyInArrow(_comparing(percent, keep), "grp long, a long, b long, cut boolean"), "pairs")
        active = pairs.where("cut").select("grp").distinct()
        fresh = materialise(few(pairs.select("a", "b").distinct().join(tried, ["a", "b"], "left_anti")), "pairs")
        if fresh.limit(1).count():
            links = links.union(materialise(few(verified(fresh)), "links"))
            tried = tried.union(fresh)
            found = components(links)
    return known.join(found, known.rep == found.node, "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id")
    )
