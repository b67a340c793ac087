"""Resharding by minimum-cost flow: from old shard sizes to new capacities, moving the fewest bytes.

Documents lie in old shards. Each old shard is cut into blocks by a hash of the group key; groups too heavy for
a block are placed one by one (there can be only so many of them). The flow from old shards to new capacities
costs nothing for bytes that stay and one a byte for bytes that move; its solution says how many bytes each pair
of shards exchanges, and whole blocks are handed over accordingly. The plan is a bounded table, so documents
learn their shard in a map-side join.
"""

from __future__ import annotations

import heapq
from collections import defaultdict

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalframe.llm.spread import listed, running, shuffled

SHARDS = 8
#: Blocks per old shard.
BLOCKS = 4096
#: A group of at least this share of a new shard is placed on its own; at most shards / share of them exist.
HEAVY = 1 / 500


def min_cost_flow(supply: list[int], room: list[int], cost: np.ndarray) -> np.ndarray:
    """Cheapest shipment of all supplies into the rooms: successive shortest paths with node potentials."""
    n, m = len(supply), len(room)
    flow, left, free = np.zeros((n, m), np.int64), list(supply), list(room)
    pot = np.zeros(n + m)
    while any(left):
        dist, back = np.full(n + m, np.inf), np.full(n + m, -1)
        queue = [(0.0, i) for i in range(n) if left[i]]
        dist[[i for _, i in queue]] = 0
        while queue:
            d, u = heapq.heappop(queue)
            if d > dist[u]:
                continue
            if u < n:
                ways = [(n + j, cost[u, j]) for j in range(m)]
            else:
                ways = [(i, -cost[i, u - n]) for i in range(n) if flow[i, u - n]]
            for v, c in ways:
                if (new := d + c + pot[u] - pot[v]) < dist[v] - 1e-9:
                    dist[v], back[v] = new, u
                    heapq.heappush(queue, (new, v))
        open_to = [j for j in range(m) if free[j] and np.isfinite(dist[n + j])]
        end = min(open_to, key=lambda j: dist[n + j] + pot[n + j])
        path = [n + end]
        while back[path[-1]] >= 0:
            path.append(int(back[path[-1]]))
        path.reverse()
        back_edges = [flow[b, a - n] for a, b in zip(path, path[1:]) if a >= n]
        moved = min([left[path[0]], free[end], *back_edges])
        for a, b in zip(path, path[1:]):
            if a < n:
                flow[a, b - n] += moved
            else:
                flow[b, a - n] -= moved
        left[path[0]] -= moved
        free[end] -= moved
        pot += np.where(np.isfinite(dist), dist, dist[np.isfinite(dist)].max())
    return flow


def _place_heavy(heavy: list, room: list[int]) -> tuple[dict, dict]:
    """Largest first: stay if there is room, else go where most room is; split what fits nowhere whole."""
    whole, split = {}, {}
    for g in sorted(heavy, key=lambda g: (-g["bytes"], g["old"], g["unit"])):
        at, old = (g["old"], g["unit"]), g["old"]
        best = old if 0 <= old < len(room) and room[old] >= g["bytes"] else int(np.argmax(room))
        if room[best] >= g["bytes"] or g["n"] == 1:
            whole[at] = best
            room[best] -= g["bytes"]
            continue
        pieces, rest, each = [], g["n"], g["bytes"] / g["n"]
        for j in sorted(range(len(room)), key=lambda j: (j != old, -room[j])):
            n = min(rest, int(max(room[j], 0) // each))
            if n:
                pieces.append((j, n))
                room[j] -= round(n * each)
                rest -= n
        while rest:
            best = int(np.argmax(room))
            pieces.append((best, 1))
            room[best] -= round(each)
            rest -= 1
        split[at] = pieces
    return whole, split


def _hand_over(blocks: list, flow: np.ndarray) -> dict[tuple[int, str], int]:
    """Whole blocks for each pair of shards, until its bytes are used up."""
    by = defaultdict(list)
    for b in sorted(blocks, key=lambda b: (b["old"], b["block"])):
        by[b["old"]].append(b)
    plan = {}
    for i, own in by.items():
        ends = np.cumsum(flow[i])
        at = 0
        for b in own:
            middle = at + b["bytes"] / 2
            plan[i, b["block"]] = min(int(np.searchsorted(ends, middle, "right")), int(np.max(np.flatnonzero(flow[i]), initial=0)))
            at += b["bytes"]
    return plan


def reshard(docs: DataFrame, size: Column, group: Column, old: Column, tie: str = "doc_id", shards: int = SHARDS) -> DataFrame:
    """Give every row a new shard of near equal bytes, moving the fewest bytes out of its old one.

    ``size`` is a row's bytes (positive), ``group`` a 64-bit key whose rows stay together within an old shard
    unless they don't fit into any shard whole, ``old`` the old shard from 0. Adds ``old_shard``, ``shard`` and
    ``slot``, the gapless place in the shard from 0, in an order by a digest of ``tie``.

    Bytes differ between shards by no more than a few blocks. A single row larger than a shard makes its shard
    larger. Groups and ties may be null; repeated rows are each placed, and interchangeable. An empty table gives
    an empty one. All columns of ``docs`` are returned.
    """
    spark = docs.sparkSession
    base = docs.withColumns({"_size": size.cast("long"), "_unit": F.coalesce(group, F.lit(0)).cast("long"), "old_shard": old.cast("int")})
    base = base.withColumn("_block", F.substring(F.md5(F.col("_unit").cast("string")), 1, 3))
    units = base.groupBy("old_shard", "_block", "_unit").agg(F.sum("_size").alias("bytes"), F.count("*").alias("n"))
    total = base.agg(F.sum("_size")).first()[0] or 0
    capacity = [total // shards + (j < total % shards) for j in range(shards)]
    is_heavy = F.col("bytes") >= max(1, int(total / shards * HEAVY))
    heavy = [
        {"old": r.old_shard, "unit": r._unit, "bytes": r.bytes, "n": r.n}
        for r in units.where(is_heavy).collect()  # at most shards / HEAVY rows
    ]
    blocks = [
        {"old": r.old_shard, "block": r._block, "bytes": r.bytes}
        for r in units.where(~is_heavy).groupBy("old_shard", "_block").agg(F.sum("bytes").alias("bytes")).collect()
    ]  # at most old shards x BLOCKS rows
    whole, split = _place_heavy(heavy, capacity)
    n_old = 1 + max([b["old"] for b in blocks], default=0)
    supply = [0] * n_old
    for b in blocks:
        supply[b["old"]] += b["bytes"]
    room = [max(0, c) for c in capacity]
    short = max(0, sum(supply) - sum(room))
    room = [c + short // shards + 1 for c in room] if short else room
    flow = min_cost_flow(supply, room, 1.0 - np.eye(n_old, shards))
    handed = _hand_over(blocks, flow)
    light_plan = listed(spark, [(i, b, j) for (i, b), j in handed.items()], "p_old int, p_block string, p_shard int")
    heavy_plan = listed(
        spark, [(i, u, whole.get((i, u))) for i, u in [*whole, *split]], "h_old int, h_unit long, h_shard int"
    )
    # Both plans are bounded by the number of shards, so broadcasting them is safe.
    placed = base.join(F.broadcast(heavy_plan), (F.col("old_shard") == F.col("h_old")) & (F.col("_unit") == F.col("h_unit")), "left")
    placed = placed.join(F.broadcast(light_plan), (F.col("old_shard") == F.col("p_old")) & (F.col("_block") == F.col("p_block")), "left")
    placed = placed.withColumn("shard", F.when(F.col("h_old").isNotNull(), F.col("h_shard")).otherwise(F.col("p_shard")))
    columns = [*docs.columns, "old_shard", "shard"]
    keyed = placed.withColumn("_key", shuffled(F.col(tie), F.col("_unit")))
    if split:
        pieces = listed(
            spark,
            [
                (i, u, int(hi - n), int(hi), j)
                for (i, u), parts in split.items()
                for (j, n), hi in zip(parts, np.cumsum([n for _, n in parts]))
            ],
            "s_old int, s_unit long, s_lo long, s_hi long, s_shard int",
        )
        ranked = running(keyed.where("h_old IS NOT NULL AND h_shard IS NULL"), ["old_shard", "_unit"], "_key", [tie], {"_rank": F.lit(1)})
        cut = (F.col("old_shard") == F.col("s_old")) & (F.col("_unit") == F.col("s_unit")) & (F.col("_rank") >= F.col("s_lo")) & (F.col("_rank") < F.col("s_hi"))
        ranked = ranked.join(F.broadcast(pieces), cut).withColumn("shard", F.col("s_shard"))
        keyed = keyed.where("shard IS NOT NULL").select(*columns, "_key").unionByName(ranked.select(*columns, "_key"))
    else:
        keyed = keyed.select(*columns, "_key")
    return running(keyed, ["shard"], "_key", [tie], {"slot": F.lit(1)}).select(*columns, F.col("slot").cast("long").alias("slot"))


def rewrite_affected(resharded: DataFrame, path: str, files_per_shard: int = 1) -> None:
    """Write the shards that lose or gain documents, one folder each; the others keep their files."""
    changed = resharded.where("shard <> old_shard").select(F.explode(F.array("shard", "old_shard")).alias("shard")).distinct()
    affected = resharded.join(F.broadcast(changed), "shard", "left_semi")  # a row a shard at most
    dealt = affected.repartition("shard", F.pmod("slot", F.lit(files_per_shard)))
    dealt.sortWithinPartitions("shard", "slot").write.mode("overwrite").partitionBy("shard").parquet(path)
