"""Prefix trie of conversations: shared openings as nodes, with totals over subtrees.

Nodes are cut into bands of a fixed number of depths. Within its band a node is found by the digests of the band's
turns under its band's root; the bands of a conversation form a shorter conversation of their own, whose
prefixes name the roots, and so on, so an array never holds more than a band. Totals go the same way: each
node explodes to its ancestors within its band only, then the roots' completed totals, summed by the same
rule over the trie of bands, are added to the nodes above them. With height H and depth D that takes about
log D / log H rounds, and a node becomes at most 2 (H + 1) rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalframe.llm.spread import join_counted
from vitalframe.sources.scratch import materialise

#: Depths to a band.
HEIGHT = 8
#: The name of the root, which no other node has.
ROOT = bytes(16)
_CHUNK = 4096


def _digest(*parts: Column) -> Column:
    return F.unhex(F.md5(F.concat(*parts)))


def positioned(turns: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, pos, said, bytes): the turns of every conversation, numbered from 1 in the order of their turn, null first.

    Turns of one number are ordered by the digests of role and text. Rows are range-sorted and counted by
    partition, so that a conversation of any length is spread over many tasks. Rows without a conversation are left out.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    said = F.concat(F.md5(F.coalesce(F.col(role_col), F.lit(""))), F.md5(text))
    slim = turns.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), said.alias("said"), F.octet_length(text).cast("long").alias("bytes")
    )
    order = ["conv", F.asc_nulls_first("turn"), "said"]
    ordered = materialise(slim.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "turns")
    place = F.row_number().over(Window.partitionBy("part", "conv").orderBy(*order[1:]))
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ordered.groupBy("part", "conv").agg(F.count("*").alias("n"))
    offsets = parts.select("part", "conv", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    placed = ordered.withColumn("place", place).join(offsets, ["part", "conv"])
    return placed.select("conv", (F.col("place") + F.col("before")).alias("pos"), F.unhex(F.md5("said")).alias("said"), "bytes")


def rebuilt(turns: DataFrame, every: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Give every conversation the opening of the one whose id is the last multiple of ``every``.

    Takes rows of `positioned`; returns (conv, depth, said, bytes) and (conv, size) of every conversation,
    those without turns included. An opening has crc32(id) modulo ``most`` turns, so it is joined as few rows.
    """
    sizes = turns.groupBy("conv").agg(F.count("*").alias("own"))
    named = sizes.withColumns({"donor": F.col("conv") - F.col("conv") % every, "h": F.crc32(F.col("conv").cast("string")) % most})
    donors = sizes.select(F.col("conv").alias("donor"), F.col("own").alias("given"))
    named = named.join(donors, "donor", "left").withColumn("taken", F.least("h", F.coalesce("given", F.lit(0))))
    named = materialise(named.select("conv", "donor", "h", "taken", "own"), "conversations")
    openings = turns.where(F.col("pos") < most).select(F.col("conv").alias("donor"), "pos", "said", "bytes")
    opened = named.join(openings, "donor").where("pos <= taken").select("conv", F.col("pos").alias("depth"), "said", "bytes")
    # an id's own turns after the opening; the ids that name them are as many as conversations, not as turns
    moved = join_counted(turns, named.select("conv", "h", "taken", "own"), "conv", "own").where("pos > h")
    own = moved.select("conv", (F.col("taken") + F.col("pos") - F.col("h")).alias("depth"), "said", "bytes")
    size = F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))
    return opened.unionByName(own), named.select("conv", size.cast("long").alias("size"))


def prefixes(turns: DataFrame, deepest: int, height: int = HEIGHT, level: int = 0) -> list[DataFrame]:
    """The prefixes of every conversation: a frame (conv, depth, key, up, whole) per level, the turns' own first.

    ``turns`` holds (conv, depth, said). ``key`` names the node, ``up`` its ancestors from its band's root
    down. On the levels above, a turn is a band of the level below, and ``whole`` says if it is a full one.
    """
    band = F.expr(f"(depth - 1) div {height}")
    # a band's turns are at most `height` entries of an array
    bands = turns.groupBy("conv", band.alias("band")).agg(F.sort_array(F.collect_list(F.struct("depth", "said"))).alias("turns"))
    bands = bands.withColumn("turns", F.col("turns.said"))
    if deepest <= height:
        above, named = [], bands.withColumns({"base": F.lit(ROOT), "last": F.lit(None).cast("binary")})
    else:
        bands = materialise(bands, f"bands-{level}")
        whole = F.array_join(F.transform("turns", F.hex), "")
        chain = bands.select("conv", (F.col("band") + 1).alias("depth"), _digest(F.lit(f"{level}:"), whole).alias("said"))
        above = prefixes(chain, -(-deepest // height), height, level + 1)
        roots = above[0].select("conv", (F.col("depth") - 1).alias("band"), F.element_at("up", -1).alias("base"), F.col("key").alias("last"))
        named = bands.join(roots, ["conv", "band"])
    inner = F.transform(
        F.sequence(F.lit(1), F.size("turns")),
        lambda i: F.when((i == height) & F.col("last").isNotNull(), F.col("last")).otherwise(
            _digest(F.lit(f"{level}/"), F.hex("base"), F.array_join(F.transform(F.slice("turns", F.lit(1), i), F.hex), ""))
        ),
    )
    keyed = named.withColumn("path", F.concat(F.array("base"), inner))
    out = keyed.select("conv", "band", "path", F.explode(F.sequence(F.lit(1), F.size("turns"))).alias("i"))
    out = out.select(
        "conv",
        (F.col("band") * height + F.col("i")).alias("depth"),
        F.get("path", F.col("i")).alias("key"),
        F.slice("path", F.lit(1), F.col("i")).alias("up"),
    )
    return [materialise(out, f"prefixes-{level}"), *above]


def rollup(levels: list[DataFrame], values: DataFrame, names: list[str], height: int = HEIGHT) -> DataFrame:
    """(key, names): sums of the values over every node's subtree, itself included; the root's without its own.

    ``levels`` holds the nodes (key, depth, up) of each level, ``values`` the first level's (key, names); a node without has 0.
    """
    nodes = levels[0].join(values, "key", "left").na.fill(0, names)
    line = F.concat("up", F.array("key"))
    sums = [F.sum(c).alias(c) for c in names]
    spread = nodes.select(F.posexplode(line).alias("i", "key"), *names)
    summed = materialise(spread.groupBy("key", (F.col("i") == 0).alias("below")).agg(*sums), "band-totals")
    inner, below = summed.where("NOT below").drop("below"), summed.where("below").drop("below")
    if len(levels) == 1:
        return inner.unionByName(below)
    strict = rollup(levels[1:], below, names, height)
    # a root's total over the bands below it, its own band's included; those roots are their bands' last depth
    done = strict.unionByName(below.where(F.col("key") == F.lit(ROOT))).groupBy("key").agg(*sums)
    done = materialise(done, "root-totals")
    ends = levels[0].where(F.col("depth") % height == 0).join(done, "key").select(F.slice(line, F.lit(2), F.size("up")).alias("line"), *names)
    passed = ends.select(F.explode("line").alias("key"), *names)
    whole = inner.unionByName(passed).groupBy("key").agg(*sums)
    return materialise(whole.unionByName(done.where(F.col("key") == F.lit(ROOT))), "totals")


def ends_digest(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256): SHA-256 of the node's decimal conversation ids, ascending and comma-joined.

    Ids are range-sorted and packed, a chunk of a node's next ids to a row; a node's chunks then stream through
    the digest in order, so a task holds one chunk at a time, however many conversations end at a node.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held = None, []

        def row(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(rows, pa.schema([("key", pa.binary()), ("first", pa.int64()), ("ids", pa.string())]))

        for b in batches:
            out = []
            for key, conv in zip(b.column("key").to_pylist(), b.column("conv").to_pylist()):
                if held and (key != held_key or len(held) == _CHUNK):
                    out.append({"key": held_key, "first": held[0], "ids": ",".join(map(str, held))})
                    held = []
                held_key = key
                held.append(conv)
            yield row(out)
        if held:
            yield row([{"key": held_key, "first": held[0], "ids": ",".join(map(str, held))}])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, state = None, None
        schema = pa.schema([("key", pa.binary()), ("ends_sha256", pa.string())])
        for b in batches:
            out = []
            for key, ids in zip(b.column("key"), b.column("ids")):
                key = key.as_py()
                if key == held_key:
                    state.update(b",")
                else:
                    if state:
                        out.append({"key": held_key, "ends_sha256": state.hexdigest()})
                    held_key, state = key, hashlib.sha256()
                state.update(ids.as_py().encode())
            yield pa.RecordBatch.from_pylist(out, schema)
        if state:
            yield pa.RecordBatch.from_pylist([{"key": held_key, "ends_sha256": state.hexdigest()}], schema)

    packed = ends.repartitionByRange("conv").sortWithinPartitions("key", "conv").mapInArrow(pack, "key binary, first long, ids string")
    return packed.repartition("key").sortWithinPartitions("key", "first").mapInArrow(digest, "key binary, ends_sha256 string")


def trie(turns: DataFrame, sizes: DataFrame, height: int = HEIGHT) -> DataFrame:
    """All nodes of the trie of conversations.

    ``turns`` holds (conv, depth, said, bytes) with depths 1, 2, ... of every conversation, ``said`` a digest
    that tells turns apart; ``sizes`` (conv, size) of every conversation, those without turns included. Returns
    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) per node: each
    distinct opening, under the smallest id that has it. Without conversations there is no node.
    """
    turns = materialise(turns, "rebuilt")
    n_convs, smallest, deepest = sizes.agg(F.count("*"), F.min("conv"), F.max("size")).first()
    levels = prefixes(turns.select("conv", "depth", "said"), deepest or 1, height)
    members = levels[0].join(turns.select("conv", "depth", "bytes"), ["conv", "depth"])
    found = members.groupBy("key").agg(
        F.min("conv").alias("conv_id"),
        F.first("depth").alias("depth"),
        F.count("*").alias("n_convs"),
        F.first("bytes").alias("bytes"),
        F.first("up").alias("up"),
    )
    found = materialise(found, "nodes")
    shapes = [found.select("key", "depth", "up")]
    shapes += [x.groupBy("key").agg(F.first("depth").alias("depth"), F.first("up").alias("up")) for x in levels[1:]]
    parented = found.withColumn("parent", F.element_at("up", -1))
    kids = parented.groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("n_children"))
    spark = turns.sparkSession
    root = spark.createDataFrame(
        [(ROOT, smallest, 0, n_convs, 0, None)] if n_convs else [], "key binary, conv_id long, depth long, n_convs long, bytes long, parent binary"
    )
    nodes = parented.drop("up").unionByName(root).join(kids, "key", "left").na.fill(0, ["n_children"])
    nodes = materialise(nodes, "nodes")
    own = nodes.where("depth > 0").select(
        "key", (F.col("n_children") == 0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved_tokens")
    )
    totals = rollup(shapes, own, ["n_leaves", "saved_tokens"], height)
    above = nodes.where("n_children > 0").select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    parents = join_counted(nodes.where("depth > 0").select("key", "parent"), above, "parent", "n_children").select("key", "parent_conv_id")
    last = sizes.where("size > 0").select("conv", F.col("size").alias("depth"))
    ends = levels[0].select("conv", "depth", "key").join(last, ["conv", "depth"]).select("key", "conv")
    ends = ends.unionByName(sizes.where("size = 0").select(F.lit(ROOT).alias("key"), "conv"))
    joined = nodes.join(totals, "key", "left").join(parents, "key", "left").join(ends_digest(ends), "key", "left")
    alone = (F.col("depth") == 0) & (F.col("n_children") == 0)
    return joined.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        F.when(alone, F.lit(1).cast("long")).otherwise(F.coalesce("n_leaves", F.lit(0))).alias("n_leaves"),
        F.coalesce("saved_tokens", F.lit(0)).cast("long").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def conversation_trie(
    conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", every: int = 5, most: int = 9
) -> DataFrame:
    """The trie of the rebuilt conversations (see `rebuilt`), a row per node (see `trie`).

    Null roles and texts are empty ones. Turns without a turn number come first; repeated rows are turns of
    their own, ordered by digest where their numbers agree. Rows without a ``conv_id`` belong to no
    conversation and are left out. An empty table has no node. Other columns are ignored.
    """
    said = materialise(positioned(conversations, id_col, turn_col, role_col, text_col), "positioned")
    return trie(*rebuilt(said, every, most))
