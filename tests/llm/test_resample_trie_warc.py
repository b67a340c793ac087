"""Importance resampling, the conversation trie and WARC archives against brute force on small odd frames."""

import gzip
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitalframe.llm import warc
from vitalframe.llm.importance import BUCKETS, extended, resample
from vitalframe.llm.spread import join_counted
from vitalframe.llm.text import SLAB_BYTES
from vitalframe.llm.trie import conversation_trie, trie
from vitalframe.llm.warc import parsed, read_records, write_archives
from vitalframe.sources.scratch import scratch_path

rng = random.Random(11)

# importance resampling


def features(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    runs = [" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]
    return w, Counter(zlib.crc32(x.encode()) % BUCKETS for x in runs)


def resampled(rows, target, percent, least):
    """(doc_id, n_features, weight, score, rank) by the definition."""
    parts = [(i, *features(t)) for i, t in rows]
    s, t = Counter(), Counter()
    for _, _, f in parts:
        s.update(f)
    for text in target:
        t.update(features(text)[1])
    ss, tt = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (ss + BUCKETS) / ((s[b] + 1) * (tt + BUCKETS)))) for b in s}
    out = []
    for i, w, f in parts:
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] * n for b, n in f.items())
        out.append([i, sum(f.values()), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(w), None])
    able = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is not None, r[0]))
    for rank, r in enumerate(able[: percent * len(able) // 100], 1):
        r[5] = rank
    return Counter((*r[:4], r[5]) for r in out)


def test_crc_of_words():
    texts = [b"a", b"", b"x" * 31, b"y" * 32, b"z" * 33, bytes(range(200)), "é".encode()]
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    got = extended(np.full(len(texts), 0xFFFFFFFF, np.uint32), data, ends - [len(t) for t in texts], ends) ^ np.uint32(0xFFFFFFFF)
    assert got.tolist() == [zlib.crc32(t) for t in texts]


@pytest.fixture(scope="module")
def texts():
    vocab = [f"w{i}é" if i % 7 == 0 else f"W{i}" for i in range(50)] + ["x" * 40]
    license_line = "The same LINE, in many documents."
    rows = []
    for i in range(120):
        lines = [" ".join(rng.choice(vocab) for _ in range(rng.choice([0, 1, 2, 9, 30]))) for _ in range(rng.choice([1, 2, 5]))]
        if rng.random() < 0.4:
            lines.insert(rng.randrange(len(lines) + 1), license_line)
        rows.append((i, rng.choice(["\n", "\n\n", "\r\n", " \n . \n"]).join(lines)))
    rows += [(200, None), (201, ""), (202, "\n \n"), (203, "one"), rows[3], rows[3], (None, "no id here\nat all " * 9), (None, None)]
    return rows


@pytest.mark.parametrize("percent, least", [(5, 20), (40, 3), (100, 0)])
def test_resample(spark, texts, percent, least):
    target = ["the same line w1é W2 W3 w7é", None, "", "W3\nW4 W5"]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3).withColumns({"rank": F.lit("x"), "weight": F.lit(1), "row": F.lit(2)})
    items = spark.createDataFrame([(t,) for t in target], "text string")
    got = resample(docs, items, percent=percent, least_words=least, carry="doc")
    # rows that tie in score and id are interchangeable, and so are their ranks
    assert Counter(map(tuple, got.select("doc_id", "n_features", "weight", "score", "rank").collect())) == resampled(texts, target, percent, least)
    assert got.select("doc.rank").distinct().collect() == [("x",)]


def test_resample_text_over_a_slab(spark):
    long = "\n".join(f"word{i} Word{i + 1}" for i in range(60_000))
    assert len(long) > SLAB_BYTES
    rows = [(1, long), (2, long.replace("\n", " ")), (3, "word5 word6")]
    got = resample(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([("word5",)], "text string"), percent=50, least_words=1)
    assert Counter(map(tuple, got.drop("n_words").collect())) == resampled(rows, ["word5"], 50, 1)


def test_resample_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    assert resample(none, some).count() == 0
    assert [tuple(r)[:3] for r in resample(some, none, least_words=1).collect()] == [(1, 3, 6)]


def test_join_counted_hot_key(spark):
    left = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    right = left.groupBy("k").agg(F.count("*").alias("n"))
    assert Counter(map(tuple, join_counted(left, right, "k", "n").collect())) == Counter(map(tuple, left.join(right, "k").collect()))
    assert join_counted(left.limit(0), right.limit(0), "k", "n").count() == 0


# conversation trie


def nodes_of(convs):
    """The contract's rows for {id: [(role, text), ...]}."""
    members = defaultdict(list)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[tuple(convs[c][:d])].append(c)
    kids = defaultdict(set)
    for path in members:
        if path:
            kids[path[:-1]].add(path)

    def below(path):
        found = [below(k) for k in kids[path]]
        saved = (len(members[path]) - 1) * len(path[-1][1].encode()) if path else 0
        return (sum(f[0] for f in found) or 1, saved + sum(f[1] for f in found))

    out = Counter()
    for path, who in members.items():
        ends = ",".join(str(c) for c in who if len(convs[c]) == len(path))
        parent = members[path[:-1]][0] if path else None
        out[(who[0], len(path), parent, len(who), len(kids[path]), *below(path), hashlib.sha256(ends.encode()).hexdigest())] += 1
    return out


def rebuilt_by_hand(rows):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            said = [hashlib.md5((x or "").encode()).hexdigest() for x in (role, text)]
            turns[c].append((turn is not None, turn, "".join(said), (role or "", text or "")))
    turns = {c: [x[3] for x in sorted(t)] for c, t in turns.items()}
    out = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = turns.get(c - c % 5, [])[:h] + own[h:]
    return out


def test_conversation_trie(spark):
    said = ["a", "b", "é" * 9, "", None]
    rows = []
    for c in [*range(60), 1003, 10**12]:
        rows += [(c, t, rng.choice(["user", "assistant"]), rng.choice(said[:2] if t < 2 else said)) for t in range(rng.choice([1, 2, 4, 12]))]
    rows += [(7, None, "user", "first"), (7, 3, None, None), (7, 3, None, None), (7, 3, "user", "tie"), (None, 0, "user", "a"), (70, 0, "user", "x" * 100_000)]
    rows += [(c, t, "user", f"same {t}") for c in range(80, 160) for t in range(20)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").repartition(3)
    df = df.withColumns({"depth": F.lit("x"), "key": F.lit(1), "conv": F.lit(None).cast("int")})
    got = conversation_trie(df)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert Counter(map(tuple, got.collect())) == nodes_of(rebuilt_by_hand(rows))
    assert conversation_trie(df.limit(0)).count() == 0


@pytest.mark.parametrize("height", [2, 3, 8])
def test_trie_of_many_bands(spark, height):
    convs = {c: [("u", rng.choice(["a", "b"]) if d % 5 == 0 else "s" * (d % 4)) for d in range(rng.choice([0, 1, 7, 30, 41]))] for c in range(40)}
    rows = [(c, d, hashlib.md5(repr(x).encode()).digest(), len(x[1])) for c, t in convs.items() for d, x in enumerate(t, 1)]
    turns = spark.createDataFrame([(a, b, bytearray(c), d) for a, b, c, d in rows], "conv long, depth long, said binary, bytes long")
    sizes = spark.createDataFrame([(c, len(t)) for c, t in convs.items()], "conv long, size long")
    assert Counter(map(tuple, trie(turns, sizes, height).collect())) == nodes_of(convs)


# WARC archives

PAGES = [
    (5, "http://a/5", "<p>" + "x" * 200),
    (3, "http://a/3", "<p>" + "x" * 200),
    (9, "http://b/9\r\nEvil: yes", "<p>" + "x" * 200),
    (4, "http://a/4", "small"),
    (6, "http://a/6", "small"),
    (7, None, None),
    (8, "", ""),
    (10, "http://a/10", "é" * 50),
    (11, "http://a/11", "é" * 50),
    (12, "http://a/12", "y" * 99),
    (13, "http://a/13", "y" * 99),
    (14, "http://é/14", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n" * 9),
    (15, "http://a/15", "long " * 200_000),
    (20, "http://a/20", "z" * 100),
    (20, "http://a/20b", "z" * 100),
    (20, "http://a/20", "w" * 100),
    (None, "http://a/n", "z" * 100),
    (None, "http://a/n2", "q" * 100),
]


def warc_rows(pages):
    groups = defaultdict(list)
    for i, (key, url, html) in enumerate(pages):
        groups[html or ""].append((key is not None, key, url, i))
    out = Counter()
    for html, rows in groups.items():
        data = html.encode()
        for n, (_, key, _, _) in enumerate(sorted(rows, key=lambda r: (r[0], r[1] or 0, r[2] or ""))):
            again = n > 0 and len(data) >= 100
            first = sorted(rows, key=lambda r: (r[0], r[1] or 0))[0][1]
            name = lambda k: "" if k is None else str(k)
            out[(name(key), len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", name(first) if again else None)] += 1
    return out


@pytest.fixture()
def pages(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").repartition(3)
    return df.withColumns({"digest": F.lit("x"), "size": F.lit(1), "key": F.lit(2), "payload": F.lit(3)})


def test_archives_round_trip(spark, pages):
    folder = scratch_path(spark, "warc")
    index = write_archives(pages, folder, "2024-01-01T00:00:00Z")
    back = read_records(index, folder).collect()
    assert Counter((r.key, r.payload_bytes, r.digest, r.record_type, r.refers_to) for r in back) == warc_rows(PAGES)
    stored = Counter(bytes(r.payload) for r in back if r.record_type == "response")
    assert stored == Counter({(h or "").encode(): 1 for _, _, h in PAGES}) + Counter([b"small", b"", ("y" * 99).encode()])
    urls = {r.key: r.url for r in back}
    assert (urls["9"], urls["7"], urls["14"]) == ("http://b/9 Evil: yes", "", "http://é/14")
    # a part of the index reads that part
    some = read_records(index.where("key IN ('4', '15')"), folder).collect()
    assert sorted(r.key for r in some) == ["15", "4"]
    assert read_records(index, folder, payloads=False).where("payload IS NOT NULL").count() == 0


def test_archives_are_plain_warc(spark, pages):
    """Each archive is a row of gzip members that the index cuts exactly, and decompresses as a whole."""
    folder = scratch_path(spark, "warc")
    rows = write_archives(pages, folder, "2024-01-01T00:00:00Z").collect()
    path = folder.removeprefix("file://")
    for name in {r.archive for r in rows}:
        data = open(f"{path}/{name}", "rb").read()
        mine = sorted((r.offset, r.length, r.key) for r in rows if r.archive == name)
        assert [o for o, _, _ in mine] == [sum(n for _, n, _ in mine[:i]) for i in range(len(mine))] and sum(mine[-1][:2]) == len(data)
        assert [parsed(gzip.decompress(data[o : o + n]))["key"] for o, n, _ in mine] == [k for _, _, k in mine]
        assert gzip.decompress(data).count(b"WARC-Record-ID") == len(mine)


def test_damage_is_an_error(spark, pages):
    folder = scratch_path(spark, "warc")
    index = write_archives(pages.coalesce(1), folder, "2024-01-01T00:00:00Z")
    first = index.orderBy("archive", "offset").first()
    path = f"{folder.removeprefix('file://')}/{first.archive}"
    data = bytearray(open(path, "rb").read())
    data[first.offset + first.length // 2] ^= 0xFF
    open(path, "wb").write(data)
    with pytest.raises(Exception, match="damaged|decompress|incorrect"):
        read_records(index, folder).collect()


def test_archives_empty(spark, pages):
    folder = scratch_path(spark, "warc")
    index = write_archives(pages.limit(0), folder, "2024-01-01T00:00:00Z")
    assert index.count() == 0 and read_records(index, folder).count() == 0


def test_blocks_join_neighbours():
    near = [("a", 0, 10), ("a", 10, 10), ("a", 20 + warc.GAP, 5), ("a", 26 + 2 * warc.GAP, 5), ("b", 0, 1), ("b", 1, warc.BLOCK), ("b", warc.BLOCK + 1, 1)]
    assert [(a, len(r)) for a, r in warc._blocks(iter(near))] == [("a", 3), ("a", 1), ("b", 1), ("b", 1), ("b", 1)]
