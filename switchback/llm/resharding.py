"""Resharding by minimum-cost flow: the block transfers that move the fewest bytes.

Rows of an old shard lie in the order of their text hash, cut into blocks, so
equal texts are neighbours. A flow from old shard sizes to new capacities says
how many bytes each old shard keeps and sends where; its amounts cut the old
shard's line of bytes into intervals, one for each new shard. A block inside
one interval is kept or moved as a file; only blocks that a cut crosses are
written again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from switchback.llm.common import landed_small
from switchback.session import cut_lineage

#: Blocks of a shard, as a power of two.
BLOCK_BITS = 10
#: A group of equal texts is split only if it holds more than this share of a shard's bytes, or of all rows.
SPLIT_SHARE = 1 / 200
SPLIT_PIECES = 256


def minimum_cost_flow(supply: list[int], capacity: list[int], cost: list[list[int]]) -> list[list[int]]:
    """Amounts from each supply to each capacity at least total cost, by shortest augmenting paths.

    Runs on one number a shard. All supply is placed; capacities must suffice.
    """
    n, m = len(supply), len(capacity)
    if sum(supply) > sum(capacity):
        raise ValueError("capacities are too small")
    flow = [[0] * m for _ in range(n)]
    left, room = list(supply), list(capacity)
    while any(left):
        # distances from all suppliers with something left; arcs back along flow cost the negative
        far = [0 if x else None for x in left]
        to: list[int | None] = [None] * m
        via_to, via_from = [-1] * m, [-1] * n
        changed = True
        while changed:
            changed = False
            for i in range(n):
                if far[i] is None:
                    continue
                for j in range(m):
                    if to[j] is None or far[i] + cost[i][j] < to[j]:
                        to[j], via_to[j], changed = far[i] + cost[i][j], i, True
            for j in range(m):
                if to[j] is None:
                    continue
                for i in range(n):
                    if flow[i][j] and (far[i] is None or to[j] - cost[i][j] < far[i]):
                        far[i], via_from[i], changed = to[j] - cost[i][j], j, True
        end = min((j for j in range(m) if room[j] and to[j] is not None), key=lambda j: to[j])
        path, j = [], end
        while True:
            i = via_to[j]
            path.append((i, j, via_from[i]))
            if via_from[i] < 0:
                break
            j = via_from[i]
        start = path[-1][0]
        amount = min([left[start], room[end], *(flow[i][back] for i, _, back in path if back >= 0)])
        for i, j, back in path:
            flow[i][j] += amount
            if back >= 0:
                flow[i][back] -= amount
        left[start] -= amount
        room[end] -= amount
    return flow


def transfers(old_sizes: dict[int, int], capacity: list[int]) -> list[tuple[int, int, int, int]]:
    """(old, new, from, to): byte intervals of each old shard and the new shard that gets them; what stays comes first."""
    olds = sorted(old_sizes)
    flow = minimum_cost_flow([old_sizes[o] for o in olds], capacity, [[0 if o == j else 1 for j in range(len(capacity))] for o in olds])
    out = []
    for o, row in zip(olds, flow):
        at = 0
        for j in sorted((j for j in range(len(capacity)) if row[j]), key=lambda j: (j != o, j)):
            out.append((o, j, at, at + row[j]))
            at += row[j]
    return out


def even_capacities(total: int, shards: int) -> list[int]:
    return [total // shards + (j < total % shards) for j in range(shards)]


def _lookup(old: Column, offset: Column, intervals: list[tuple[int, int, int, int]]) -> Column:
    found = F.lit(None).cast("int")
    for o, j, start, _ in sorted(intervals, key=lambda t: (t[0], t[2])):
        found = F.when((old == o) & (offset >= start), F.lit(j)).otherwise(found)
    return found


def reshard(rows: DataFrame, shards: int, capacity: list[int] | None = None) -> DataFrame:
    """``id, hash, size, old, block, shard, slot`` for rows of (id, hash, size, old).

    ``hash`` (64 bits) puts equal texts side by side. Sizes of new shards follow
    ``capacity`` (even by default) up to single texts, or to SPLIT_SHARE where a
    group of equal texts is kept whole; larger groups are split by pieces of
    their ids, so no task gathers one. Slots are gapless from 0 in each shard.
    Repeated rows and null ids are placed like others. An empty table stays empty.
    Other columns stay, but for those named like an own one. The driver holds a
    number for each shard.
    """
    made = ("block", "piece", "shard", "slot", "start", "number", "first_slot")
    carried = [c for c in rows.columns if c not in ("id", "hash", "size", "old", *made)]
    rows = cut_lineage(rows.select("id", "hash", "size", "old", *carried).withColumns({
        "block": F.shiftrightunsigned("hash", 64 - BLOCK_BITS).cast("int"),
        "piece": F.pmod(F.xxhash64("id", "hash"), F.lit(SPLIT_PIECES)).cast("int"),
    }))
    old_sizes = {r["old"]: (r["bytes"], r["n"]) for r in rows.groupBy("old").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).collect()}
    total, count = (sum(v[k] for v in old_sizes.values()) for k in (0, 1))
    capacity = capacity or even_capacities(total, shards)
    intervals = transfers({o: b for o, (b, _) in old_sizes.items()}, capacity)
    groups = rows.groupBy("old", "block", "hash").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    blocks = groups.groupBy("old", "block").agg(F.sum("bytes").alias("bytes")).select(
        "old", "block", F.coalesce(F.sum("bytes").over(before(Window.partitionBy("old").orderBy("block"))), F.lit(0)).alias("block_start")
    )
    inside = F.coalesce(F.sum("bytes").over(before(Window.partitionBy("old", "block").orderBy("hash"))), F.lit(0))
    placed = groups.withColumn("inside", inside).join(blocks, ["old", "block"]).withColumn("start", F.col("block_start") + F.col("inside"))
    large = (F.col("bytes") > SPLIT_SHARE * total / shards) | (F.col("n") > max(1000, SPLIT_SHARE * count / shards))
    placed = cut_lineage(placed.select("old", "hash", "start", large.alias("large"), _lookup(F.col("old"), F.col("start"), intervals).alias("shard")))
    # at most 2 * shards / SPLIT_SHARE groups are large
    split = landed_small(placed.filter("large").select("old", "hash", "start"))
    of_large = rows.join(split, ["old", "hash"])
    in_group = before(Window.partitionBy("old", "hash").orderBy("piece"))
    pieces = of_large.groupBy("old", "hash", "piece").agg(F.sum("size").alias("bytes"), F.first("start").alias("start")).select(
        "old", "hash", "piece",
        _lookup(F.col("old"), F.col("start") + F.coalesce(F.sum("bytes").over(in_group), F.lit(0)), intervals).alias("shard"),
    )
    pieces = landed_small(pieces)
    own = ["id", "hash", "size", "old", "block", "piece", *carried]
    in_large = of_large.select(*own).join(pieces, ["old", "hash", "piece"]).select(*own, "shard")
    in_small = rows.join(split.select("old", "hash"), ["old", "hash"], "left_anti").join(placed.filter(~F.col("large")).select("old", "hash", "shard"), ["old", "hash"])
    assigned = cut_lineage(in_small.select(*own, "shard").unionByName(in_large))
    counts = assigned.groupBy("shard", "piece").agg(F.count("*").alias("n")).select(
        "shard", "piece", F.coalesce(F.sum("n").over(before(Window.partitionBy("shard").orderBy("piece"))), F.lit(0)).alias("first_slot")
    )
    number = F.row_number().over(Window.partitionBy("shard", "piece").orderBy("id", "hash", "old")) - 1
    out = assigned.withColumn("number", number).join(landed_small(counts), ["shard", "piece"])
    return out.select("id", "hash", "size", "old", *carried, "block", "shard", (F.col("first_slot") + F.col("number")).alias("slot"))


def block_actions(resharded: DataFrame) -> DataFrame:
    """``old, block, action``: ``kept`` or ``moved`` as a file (then ``shard``), or ``rewritten`` (shard null)."""
    ends = resharded.groupBy("old", "block").agg(F.min("shard").alias("a"), F.max("shard").alias("b"))
    action = F.when(F.col("a") != F.col("b"), "rewritten").when(F.col("a") == F.col("old"), "kept").otherwise("moved")
    return ends.select("old", "block", action.alias("action"), F.when(F.col("a") == F.col("b"), F.col("a")).alias("shard"))


def rewrite(resharded: DataFrame, old_path: str, new_path: str, row_id: Column, row_hash: Column) -> DataFrame:
    """Writes the rows of crossed blocks to ``new_path`` and returns where every block of the new layout lies.

    ``old_path`` is laid out by folders ``old=…/block=…``. ``row_id`` and
    ``row_hash`` give a stored row's id and hash. Returns ``shard, block, path``;
    blocks that are kept or moved stay the files they are.
    """
    spark = resharded.sparkSession
    actions = cut_lineage(block_actions(resharded))
    crossed = landed_small(actions.filter(F.col("action") == "rewritten").select("old", "block"))
    whole = actions.filter(F.col("shard").isNotNull()).select(
        "shard", "block", F.concat(F.lit(f"{old_path}/old="), F.col("old"), F.lit("/block="), F.col("block")).alias("path")
    )
    if crossed.isEmpty():
        return whole
    goes = resharded.join(crossed, ["old", "block"], "left_semi").select(
        F.col("id").alias("__to_id"), F.col("hash").alias("__to_hash"), F.col("shard").alias("__shard")
    ).distinct()
    stored = spark.read.parquet(old_path).join(crossed, ["old", "block"], "left_semi")
    keyed = stored.withColumns({"__id": row_id, "__hash": row_hash})
    joined = keyed.join(goes, keyed["__id"].eqNullSafe(goes["__to_id"]) & (keyed["__hash"] == goes["__to_hash"]))
    joined.drop("__id", "__hash", "__to_id", "__to_hash", "old").withColumnRenamed("__shard", "shard").write.partitionBy("shard", "block").parquet(new_path)
    fresh = spark.read.parquet(new_path).select("shard", "block").distinct()
    return whole.unionByName(fresh.withColumn("path", F.concat(F.lit(f"{new_path}/shard="), F.col("shard"), F.lit("/block="), F.col("block"))))

