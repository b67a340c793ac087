"""WARC archives of web pages: written with an index, read back by coalesced byte ranges.

Every record is a gzip member of its own. A task writes its records to archives under a name of its own and returns
their index rows; only the rows of tasks that Spark commits become the index, so an archive left by a lost
executor is never read. Readers take an index, or a part of it, sort it by place and read neighbours at once.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitalframe.llm.spread import join_counted, width
from vitalframe.sources.scratch import materialise

#: A payload of fewer bytes is always written out.
LEAST_BYTES = 100
#: An archive is closed when it has so many bytes.
ARCHIVE_BYTES = 256 << 20
#: Ranges are read at once if no more than GAP bytes lie between them, up to BLOCK bytes.
GAP, BLOCK = 64 << 10, 4 << 20
#: A reading task gets no more archive bytes than MOST_BYTES, and no fewer than LEAST_TASK_BYTES if there are enough.
MOST_BYTES, LEAST_TASK_BYTES = 64 << 20, 4 << 20
#: Rows that a writer turns into Python objects at a time.
_ROWS = 256

_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_INDEX = "archive string, offset long, length long, key string, url string, digest string, record_type string"
_RECORD = "key string, url string, record_type string, refers_to string, payload_bytes long, digest string, payload binary"


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path, and the path within it."""
    return pafs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", path))


def _line(value: str | None) -> str:
    """A header value: no line ends, as they would end the header."""
    return re.sub(r"[\r\n]+", " ", value or "").strip()


def record(key: str, url: str, date: str, digest: str, payload: bytes, size: int, refers_to: str | None) -> bytes:
    """One record: a response with its payload, or, with ``refers_to``, a revisit of that record without it."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:record:{key}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {_line(url)}",
        f"WARC-Payload-Digest: sha256:{digest}",
    ]
    if refers_to is not None:
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <urn:record:{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(data: bytes) -> dict:
    """The fields of one record, as `read_records` returns them."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    name = re.compile(r"<urn:record:(.*)>", re.S)
    revisit = fields["WARC-Type"] == "revisit"
    size = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
    return {
        "key": name.fullmatch(fields["WARC-Record-ID"])[1],
        "url": fields.get("WARC-Target-URI", ""),
        "record_type": fields["WARC-Type"],
        "refers_to": name.fullmatch(fields["WARC-Refers-To"])[1] if revisit else None,
        "payload_bytes": size,
        "digest": fields["WARC-Payload-Digest"].removeprefix("sha256:"),
        "payload": None if revisit else payload,
    }


def decided(pages: DataFrame) -> DataFrame:
    """Rows (key, url, payload) with ``digest``, ``size`` and, for revisits, ``refers_to``.

    Of the rows whose payloads are equal and long enough, the first by key, then url, is written out. Digests are
    compared without their payloads; a payload that very many pages share is joined by broadcast.
    """
    digested = pages.withColumns({"digest": F.sha2("payload", 256), "size": F.octet_length("payload").cast("long")})
    slim = digested.where(F.col("size") >= LEAST_BYTES).groupBy("digest", "key").agg(F.count("*").alias("rows"))
    slim = materialise(slim, "digests")
    # the smallest key comes first; null is smaller than any
    first = F.min(F.struct(F.col("key").isNotNull().alias("named"), "key")).alias("first")
    shared = slim.groupBy("digest").agg(first, F.count("*").alias("keys"), F.sum("rows").alias("n")).where("n > 1")
    copies = join_counted(slim, shared.select("digest", "first", "keys"), "digest", "keys")
    # One text for digest and key, without the key if it is null, so that join and window share one shuffle of the payloads.
    spot = F.concat_ws(":", "digest", F.col("key").cast("string"))
    copies = copies.select(spot.alias("spot"), F.col("first.key").alias("first_key"), F.lit(True).alias("copied"))
    met = digested.withColumn("spot", spot).join(copies, "spot", "left").withColumn("copied", F.coalesce("copied", F.lit(False)))
    # rows of one key and payload are told apart by their place among themselves
    place = F.row_number().over(Window.partitionBy("spot").orderBy("url"))
    again = F.col("copied") & (~F.col("key").eqNullSafe(F.col("first_key")) | (F.col("place") > 1))
    return met.withColumn("place", place).select(
        "key", "url", "payload", "digest", "size", again.alias("revisit"), F.when(again, F.coalesce(F.col("first_key").cast("string"), F.lit(""))).alias("refers_to")
    )


def write_archives(pages: DataFrame, folder: str, date: str, key_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Write a record per row of ``pages`` to gzipped archives in ``folder``; returns the index, itself written to scratch.

    ``folder`` is a path that every executor reaches; ``date`` stands in every record. Index rows hold archive,
    offset, length, key (the row's, as text), url, digest (SHA-256 of the payload) and record_type. A null payload is an empty one,
    a null key or url an empty text; line ends in urls become spaces. Repeated rows are records of their own, the second a
    revisit if it is long enough. An empty table gives no archive and an empty index. Other columns are ignored.
    """
    rows = pages.select(
        F.col(key_col).alias("key"), F.coalesce(F.col(url_col), F.lit("")).alias("url"), F.coalesce(F.col(payload_col), F.lit("")).alias("payload")
    )
    rows = decided(rows).withColumn("key", F.coalesce(F.col("key").cast("string"), F.lit(""))).drop("revisit")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(folder)
        store.create_dir(root, recursive=True)
        out, name, at = None, "", 0
        try:
            for b in (part for whole in batches for part in pa.Table.from_batches([whole]).to_batches(_ROWS)):
                found = []
                for r in b.to_pylist():
                    if out is None or at >= ARCHIVE_BYTES:
                        if out is not None:
                            out.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = store.open_output_stream(f"{root}/{name}", compression=None)
                    data = record(r["key"], r["url"], date, r["digest"], r["payload"].encode(), r["size"], r["refers_to"])
                    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                    member = packer.compress(data) + packer.flush()
                    out.write(member)
                    kind = "response" if r["refers_to"] is None else "revisit"
                    found.append((name, at, len(member), r["key"], _line(r["url"]), r["digest"], kind))
                    at += len(member)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*found)], ["archive", "offset", "length", "key", "url", "digest", "record_type"])
        finally:
            if out is not None:
                out.close()

    return materialise(rows.mapInArrow(write, _INDEX), "warc-index")


def _blocks(rows: Iterator[tuple[str, int, int]]) -> Iterator[tuple[str, list[tuple[int, int]]]]:
    """Neighbouring ranges of an archive, as long as they make one read."""
    name, held = "", []
    for archive, offset, length in rows:
        if held and (archive != name or offset > sum(held[-1]) + GAP or offset + length - held[0][0] > BLOCK):
            yield name, held
            held = []
        name = archive
        held.append((offset, length))
    if held:
        yield name, held


def read_records(index: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records of the index rows: key, url, record_type, refers_to, payload_bytes, digest, payload.

    The rows are sorted by archive and offset, cut into ranges of even size among the tasks, and read in blocks:
    neighbours with small gaps in one read. A response's digest and length are those of the payload that was read;
    a payload that doesn't match its header is an error. A revisit has those of the record it refers to and
    a null payload. Without ``payloads`` they are all null.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(folder)
        wanted = ((a, o, n) for b in batches for a, o, n in zip(*(b.column(c).to_pylist() for c in ("archive", "offset", "length"))))
        held, name = None, None
        schema = pa.schema([(c, pa.int64() if c == "payload_bytes" else pa.binary() if c == "payload" else pa.string()) for c in columns])
        try:
            for archive, ranges in _blocks(wanted):
                if archive != name:
                    if held is not None:
                        held.close()
                    held, name = store.open_input_file(f"{root}/{archive}"), archive
                base = ranges[0][0]
                data = memoryview(held.read_at(sum(ranges[-1]) - base, base))
                rows = []
                for offset, length in ranges:
                    r = parsed(zlib.decompress(data[offset - base : offset - base + length], 31))
                    if r["payload"] is not None:
                        found = hashlib.sha256(r["payload"]).hexdigest()
                        if found != r["digest"] or len(r["payload"]) != r["payload_bytes"]:
                            raise ValueError(f"record {r['key']} of {archive} is damaged")
                    rows.append(r if payloads else r | {"payload": None})
                yield pa.RecordBatch.from_pylist(rows, schema)
        finally:
            if held is not None:
                held.close()

    columns = [c.split()[0] for c in _RECORD.split(", ")]
    # The rows are small, what they stand for isn't: tasks are counted by archive bytes.
    much = index.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    tasks = max(1, min(max(width(index.sparkSession), much // MOST_BYTES), much // LEAST_TASK_BYTES))
    ordered = index.select("archive", "offset", "length").repartitionByRange(tasks, "archive", "offset").sortWithinPartitions("archive", "offset")
    return ordered.mapInArrow(read, _RECORD)
