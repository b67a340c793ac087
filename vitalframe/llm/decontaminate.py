"""Benchmark decontamination: a broadcast hash set of test n-grams against every window of every document.

The benchmark is cut into blocks of bounded size. The windows of one block are hashed and broadcast; each
document's rolling hashes are looked up, and every hit is verified on the words themselves. All blocks but
the usual one cost one more pass each, so a benchmark of any size is handled by the same path.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalframe.sources.scratch import materialise
from vitalframe.llm.text import ALNUM, LOWER, released, slabs

WINDOW = 10
#: UTF-8 bytes of benchmark text behind one broadcast; its hash set is at most a few times that.
BLOCK_BYTES = 32 << 20

RESULT = "doc_id long, n_words long, n_hit long, items array<string>, spans array<struct<begin:long,end:long>>, clean string"


class TestWindows:
    """Windows of a block of benchmark items: sorted hashes, and for each the items and words it stands for."""

    __test__ = False

    def __init__(self, ids: list[str], texts: list[str | None], k: int):
        keys, owners, lengths, words = [], [], [], []
        for slab in slabs(pa.array(texts, pa.string())):
            slab.data = LOWER[slab.data]
            slab.split(ALNUM)
            at, owner, h = slab.windows(slab.hashes(), k, short=True)
            n = np.minimum(k, slab.n_words[owner])
            keys.append(h)
            owners.append(owner + slab.lo)
            lengths.append(n)
            words += [b" ".join(slab.data[slab.starts[j] : slab.ends[j]].tobytes() for j in range(a, a + m)) for a, m in zip(at, n)]
        self.ids = np.array(ids, object)
        h = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        order = np.argsort(h, kind="stable")
        self.hashes = h[order]
        self.owner = np.concatenate(owners)[order] if keys else np.zeros(0, np.int64)
        self.length = np.concatenate(lengths)[order] if keys else np.zeros(0, np.int64)
        self.words = [words[i] for i in order]
        self.sizes = np.unique(self.length)


_SPANS = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
_FOUND = "doc_id long, text string, items array<string>, spans array<struct<begin:long,end:long>>"


def _scanning(shared, k: int):
    """Add the hits of one block to the items and word intervals that earlier blocks left."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests: TestWindows = shared.value
        known = {int(n): np.unique(tests.hashes[tests.length == n]) for n in tests.sizes}
        for part in parts:
            items, spans = part.column("items"), part.column("spans")
            for slab in slabs(part.column("text")):
                slab.data = LOWER[slab.data]
                slab.split(ALNUM)
                word_hashes = slab.hashes()
                n_texts = slab.hi - slab.lo
                ids = {i: set(items[slab.lo + i].as_py()) for i in range(n_texts) if len(items[slab.lo + i].values)}
                edge = np.zeros(len(slab.starts) + 1, np.int64)
                for i in ids:
                    for x in spans[slab.lo + i].as_py():
                        edge[slab.first[i] + x["begin"]] += 1
                        edge[slab.first[i] + x["end"]] -= 1
                for n, hashes in known.items():
                    at, owner, h = slab.windows(word_hashes, n)
                    found = hashes[np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)] == h
                    for a, o, x in zip(at[found], owner[found], h[found]):
                        said = b" ".join(slab.data[slab.starts[j] : slab.ends[j]].tobytes() for j in range(a, a + n))
                        for t in range(np.searchsorted(tests.hashes, x), np.searchsorted(tests.hashes, x, "right")):
                            if tests.length[t] == n and tests.words[t] == said:
                                ids.setdefault(int(o), set()).add(tests.ids[tests.owner[t]])
                                edge[a] += 1
                                edge[a + n] -= 1
                covered = np.cumsum(edge)[:-1] > 0
                runs: list[list] = [[] for _ in range(n_texts)]
                for i in ids:
                    a, b = slab.first[i], slab.first[i + 1]
                    step = np.flatnonzero(np.diff(np.concatenate([[0], covered[a:b], [0]])))
                    runs[i] = [{"begin": int(x), "end": int(y)} for x, y in zip(step[::2], step[1::2])]
                yield pa.RecordBatch.from_arrays(
                    [
                        *[part.column(c).slice(slab.lo, n_texts) for c in ("doc_id", "text")],
                        pa.array([sorted(ids.get(i, ())) for i in range(n_texts)], pa.list_(pa.string())),
                        pa.array(runs, _SPANS),
                    ],
                    ["doc_id", "text", "items", "spans"],
                )

    return run


def _cleaning(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Count the words, and cut each interval out of the original text, from its first word to its last."""
    for part in parts:
        spans = part.column("spans")
        for slab in slabs(part.column("text")):
            slab.split(ALNUM)
            n_hit = np.zeros(slab.hi - slab.lo, np.int64)
            clean = part.column("text").slice(slab.lo, slab.hi - slab.lo).to_pylist()
            for i in range(slab.hi - slab.lo):
                if len(spans[slab.lo + i].values):
                    text, kept, done = slab.text(i), [], 0
                    for x in spans[slab.lo + i].as_py():
                        n_hit[i] += x["end"] - x["begin"]
                        first, last = slab.first[i] + x["begin"], slab.first[i] + x["end"] - 1
                        kept.append(text[done : slab.starts[first] - slab.offsets[i]])
                        done = slab.ends[last] - slab.offsets[i]
                    clean[i] = b"".join([*kept, text[done:]]).decode()
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id").slice(slab.lo, len(n_hit)),
                    pa.array(slab.n_words),
                    pa.array(n_hit),
                    part.column("items").slice(slab.lo, len(n_hit)),
                    spans.slice(slab.lo, len(n_hit)),
                    pa.array(clean, pa.string()),
                ],
                ["doc_id", "n_words", "n_hit", "items", "spans", "clean"],
            )


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    k: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Find every benchmark window of ``k`` words in every document.

    Words are ASCII letters and digits and all other non-ASCII characters, A-Z lower-cased. An item of fewer words
    is one window. Returns (doc_id, n_words, n_hit, items, spans, clean): ``n_hit`` words stand inside an occurring
    window, ``items`` are the sorted ids (as text) of the items with one, ``spans`` the maximal hit intervals in
    words, ``clean`` the text without them. Drop documents with ``n_hit > 0``, or keep ``clean``.

    Null and empty texts have no words and no hits (``clean`` keeps null). Items with a null id or without words
    hit nothing; rows with the same item id count as one item. Repeated documents are each returned; an empty
    table on either side gives no hits. Other columns are ignored.
    """
    spark = docs.sparkSession
    tests = benchmark.select(F.col(item_col).cast("string").alias("id"), F.col(item_text_col).cast("string").alias("text")).dropna()
    size = tests.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    found = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
        F.array().cast("array<string>").alias("items"),
        F.array().cast("array<struct<begin:long,end:long>>").alias("spans"),
    )
    for block in range(blocks):
        here = tests if blocks == 1 else tests.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == block)
        rows = here.collect()  # bounded by the block
        shared = spark.sparkContext.broadcast(TestWindows([r.id for r in rows], [r.text for r in rows], k))
        if block:
            found = materialise(found, "leaks")  # so that one block's windows are in memory at a time
        scanning = _scanning(shared, k)
        if block < blocks - 1:
            found = found.mapInArrow(released(scanning), _FOUND)
    # One Python step for the last block and the cuts: two in a row would take two workers a core, and send the texts twice.
    return found.mapInArrow(released(lambda parts: _cleaning(scanning(parts))), RESULT)
