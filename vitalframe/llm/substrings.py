"""Substring dedup: Rabin-Karp hashes of all fixed-length word windows, counted across documents.

Every window's rolling hash goes to the bucket of its leading bits, next to the document it starts in.
A bucket sorts its hashes, finds the smallest document of each, and tells the other documents which of their
windows repeat. Overlapping repeats merge into maximal removal intervals.

Windows that repeat within one map batch are settled there and leave one record, so a passage shared by a
third of all documents reaches its bucket once per batch, not once per document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalframe.llm.spread import width
from vitalframe.llm.text import SPACED, Slab, slabs

WINDOW = 13
#: Bytes of text whose windows travel as one blob per bucket.
BATCH_BYTES = 8 << 20

RESULT = "doc_id long, n_words long, n_removed long, spans array<struct<begin:long,end:long>>, kept string"


def _narrow(h: np.ndarray, n_bytes: int) -> np.ndarray:
    """The low bytes of 64-bit hashes, packed."""
    return np.ascontiguousarray(h).view(np.uint8).reshape(-1, 8)[:, :n_bytes].reshape(-1)


def _wide(packed: np.ndarray, n_bytes: int) -> np.ndarray:
    out = np.zeros((len(packed) // n_bytes, 8), np.uint8)
    out[:, :n_bytes] = packed.reshape(-1, n_bytes)
    return out.reshape(-1).view(np.uint64)


def _packed(doc: np.ndarray, h: np.ndarray, n_bytes: int) -> bytes:
    """Hashes by document: the documents, how many hashes each has, the low bytes of each hash."""
    ids, counts = np.unique(doc, return_counts=True)
    head = np.array([len(ids)], np.uint32).tobytes() + np.diff(ids, prepend=0).tobytes() + counts.astype(np.uint32).tobytes()
    return head + _narrow(h[np.argsort(doc, kind="stable")], n_bytes).tobytes()


def _unpacked(blob: pa.Scalar, n_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(blob.as_buffer(), np.uint8)
    n = int(raw[:4].view(np.uint32)[0])
    ids, counts = np.cumsum(raw[4 : 4 + 8 * n].view(np.int64)), raw[4 + 8 * n : 4 + 12 * n].view(np.uint32)
    return np.repeat(ids, counts), _wide(raw[4 + 12 * n :], n_bytes)


def _by(key: np.ndarray, doc: np.ndarray, h: np.ndarray, n_bytes: int) -> tuple[np.ndarray, list[bytes]]:
    """One blob for each value of ``key``."""
    order = np.argsort(key, kind="stable")
    kinds, at = np.unique(key[order], return_index=True)
    doc, h = doc[order], h[order]
    return kinds, [_packed(doc[a:b], h[a:b], n_bytes) for a, b in zip(at, [*at[1:], len(order)])]


_SENT = pa.schema([("bucket", pa.int64()), ("part", pa.int64()), ("blob", pa.binary())])


def _send(doc: np.ndarray, h: np.ndarray, bits: int, parts: int) -> Iterator[pa.RecordBatch]:
    """Blobs of one batch: seven bytes of each hash by bucket; what the batch itself settles by part of documents."""
    order = np.lexsort((doc, h))
    doc, h = doc[order], h[order]
    fresh = np.append(True, h[1:] != h[:-1]) if len(h) else np.zeros(0, bool)
    other = np.append(True, doc[1:] != doc[:-1]) if len(h) else fresh
    least = doc[fresh][np.cumsum(fresh) - 1] if len(h) else doc
    late = ~fresh & other & (doc > least)
    if late.any():
        told, blobs = _by(doc[late] % parts, doc[late], h[late], 6)
        yield pa.RecordBatch.from_arrays([pa.array(told % (1 << bits)), pa.array(told), pa.array(blobs, pa.binary())], schema=_SENT)
    doc, h = doc[fresh], h[fresh]
    if len(h):
        kinds, blobs = _by((h >> np.uint64(64 - bits)).astype(np.int64), doc, h, 7)
        none = pa.nulls(len(kinds), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(kinds), none, pa.array(blobs, pa.binary())], schema=_SENT)


def _hashing(k: int, bits: int, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, hashes, held = [], [], 0
        for part in batches:
            ids = part.column("doc_id").to_numpy(zero_copy_only=False)
            for slab in slabs(part.column("text")):
                slab.split(SPACED)
                _, owner, h = slab.windows(slab.hashes(), k)
                docs.append(ids[slab.lo : slab.hi][owner])
                hashes.append(h)
                held += len(slab.data)
                if held >= BATCH_BYTES:
                    yield from _send(np.concatenate(docs), np.concatenate(hashes), bits, parts)
                    docs, hashes, held = [], [], 0
        if docs:
            yield from _send(np.concatenate(docs), np.concatenate(hashes), bits, parts)

    return run


def _counting(parts: int):
    """One bucket: which windows of which documents also start in a smaller document, a blob for each part."""

    def run(table: pa.Table) -> pa.Table:
        docs, hashes, told, blobs = [], [], [], []
        for part, blob in zip(table.column("part").to_pylist(), table.column("blob")):
            if part is not None:
                told.append(np.array([part]))
                blobs.append(blob.as_py())
                continue
            doc, h = _unpacked(blob, 7)
            docs.append(doc)
            hashes.append(h)
        if docs:
            doc, h = np.concatenate(docs), np.concatenate(hashes)
            order = np.argsort(h)
            doc, h = doc[order], h[order]
            fresh = np.append(True, h[1:] != h[:-1])
            least = np.minimum.reduceat(doc, np.flatnonzero(fresh))[np.cumsum(fresh) - 1]
            late = doc > least
            kinds, more = _by(doc[late] % parts, doc[late], h[late], 6)
            told.append(kinds)
            blobs += more
        told = np.concatenate(told) if told else np.zeros(0, np.int64)
        return pa.table({"part": pa.array(told, pa.int64()), "blob": pa.array(blobs, pa.binary())})

    return run


def removal(slab: Slab, at: np.ndarray, k: int) -> np.ndarray:
    """Words covered by windows that start at the given words."""
    edge = np.zeros(len(slab.starts) + k + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + k, -1)
    return np.cumsum(edge)[: len(slab.starts)] > 0


def joined(slab: Slab, kept: np.ndarray) -> pa.Array:
    """Kept words of each text, joined by one space."""
    starts, length = slab.starts[kept], (slab.ends - slab.starts)[kept]
    ends = np.cumsum(length + 1)
    n_kept = np.diff(np.concatenate([[0], np.cumsum(kept)])[slab.first])
    total = int(ends[-1]) if len(ends) else 0
    source = np.arange(total) + np.repeat(starts - (ends - length - 1), length + 1)
    out = slab.data[np.minimum(source, len(slab.data) - 1)] if total else np.zeros(0, np.uint8)
    out[ends - 1] = 0x20
    last = np.cumsum(n_kept)[n_kept > 0] - 1
    keep = np.ones(total, bool)
    keep[ends[last] - 1] = False
    sizes = np.zeros(len(n_kept), np.int64)
    owner = np.repeat(np.arange(len(n_kept)), n_kept)
    np.add.at(sizes, owner, length + 1)
    offsets = np.concatenate([[0], np.cumsum(sizes - (n_kept > 0))]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(n_kept), pa.py_buffer(offsets), pa.py_buffer(out[keep])).cast(pa.string())


def intervals(slab: Slab, gone: np.ndarray) -> pa.Array:
    """Maximal runs of removed words of each text, as word positions [begin, end)."""
    n = len(gone)
    head = np.zeros(n + 1, bool)
    head[slab.first[:-1]] = True
    head = head[:n]
    tail = np.append(head[1:], True)[:n]
    begin = np.flatnonzero(gone & (head | ~np.append(False, gone[:-1])[:n]))
    end = np.flatnonzero(gone & (tail | ~np.append(gone[1:], False)[:n])) + 1
    owner = np.searchsorted(slab.first, begin, "right") - 1
    base = slab.first[owner]
    pairs = pa.StructArray.from_arrays([pa.array(begin - base), pa.array(end - base)], ["begin", "end"])
    offsets = np.searchsorted(owner, np.arange(len(slab.first))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pairs)


def _removing(k: int):
    """One part of the documents and what was told about it."""

    def run(docs: pa.Table, told: pa.Table) -> pa.Table:
        found = [_unpacked(blob, 6) for blob in told.column("blob")]
        doc, low = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64), np.zeros(0, np.uint64))
        order = np.argsort(doc, kind="stable")
        doc, low = doc[order], low[order]
        ids = docs.column("doc_id").fill_null(-1).to_numpy()
        begin, end = np.searchsorted(doc, ids), np.searchsorted(doc, ids, "right")
        named = docs.column("doc_id").is_valid().to_numpy()
        out = []
        for slab in slabs(docs.column("text")):
            slab.split(SPACED)
            at, owner, h = slab.windows(slab.hashes(), k)
            hit = np.zeros(len(at), bool)
            ends = np.searchsorted(owner, np.arange(slab.hi - slab.lo + 1))
            for i in np.flatnonzero((end > begin)[slab.lo : slab.hi] & named[slab.lo : slab.hi]):
                a, b = ends[i], ends[i + 1]
                hit[a:b] = np.isin(h[a:b] & np.uint64((1 << 48) - 1), low[begin[slab.lo + i] : end[slab.lo + i]])
            gone = removal(slab, at[hit], k)
            removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[slab.first])
            out.append(
                pa.table(
                    [docs.column("doc_id").slice(slab.lo, slab.hi - slab.lo), pa.array(slab.n_words), pa.array(removed), intervals(slab, gone), joined(slab, ~gone)],
                    ["doc_id", "n_words", "n_removed", "spans", "kept"],
                )
            )
        return pa.concat_tables(out) if out else _NONE

    return run


_NONE = pa.table(
    {
        "doc_id": pa.array([], pa.int64()), "n_words": pa.array([], pa.int64()), "n_removed": pa.array([], pa.int64()),
        "spans": pa.array([], pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))), "kept": pa.array([], pa.string()),
    }
)


def remove_repeats(docs: DataFrame, k: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None) -> DataFrame:
    """Remove every word that a repeated window of ``k`` words covers.

    A window counts as repeated if its words also stand in a row in a document with a smaller id. Returns
    (doc_id, n_words, n_removed, spans, kept): ``spans`` are the maximal removed intervals in words, ``kept`` is
    the text of the words left, joined by one space.

    Null or empty texts have no words and keep an empty text. Texts under ``k`` words stay whole. Rows with the
    same id don't remove each other's words; each is returned. Rows with a null id stay whole and remove
    nothing. An empty table gives an empty one; other columns are ignored. ``buckets`` (a power of two; by
    default the shuffle width or more) sets how many parts the hashes are counted in, and the documents
    finished in; a part of either has to fit a task.
    """
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    bits = max(1, ((buckets or width(docs.sparkSession)) - 1).bit_length())
    parts = (1 << bits) + 1  # odd, so that ids with a common power of two still spread
    sent = slim.where("doc_id IS NOT NULL").mapInArrow(_hashing(k, bits, parts), "bucket long, part long, blob binary")
    told = sent.groupBy("bucket").applyInArrow(_counting(parts), "part long, blob binary")
    parted = slim.withColumn("part", F.pmod(F.coalesce("doc_id", F.xxhash64("text")), F.lit(parts)))
    return parted.groupBy("part").cogroup(told.groupBy("part")).applyInArrow(_removing(k), RESULT)
