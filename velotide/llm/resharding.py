"""Resharding by minimum-cost flow: the fewest bytes move, only touched files are rewritten."""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from velotide.llm.common import shuffle_partitions
from velotide.sources.scratch import materialize, scratch_path

# Movable blocks for each shard: the rest of a balance is about half a block.
BLOCKS_A_SHARD = 128
# Files for each old shard; a file holds neighbouring blocks.
FILES_A_SHARD = 16


def minimum_cost_flow(supply: list[int], demand: list[int], cost: list[list[int]]) -> list[list[int]]:
    """Cheapest shipment of all supply, at most ``demand[j]`` into j, by shortest augmenting paths.

    ``cost[i][j]`` is paid for each unit from i to j and is not negative.  Total
    demand must be at least total supply.
    """
    if sum(demand) < sum(supply):
        raise ValueError("capacities are smaller than what is stored")
    n, m = len(supply), len(demand)
    flow = [[0] * m for _ in range(n)]
    left, room = list(supply), list(demand)
    potential = [0] * (n + m)
    while any(left):
        distance, came = [None] * (n + m), [None] * (n + m)
        queue = [(0, i) for i in range(n) if left[i]]
        for _, i in queue:
            distance[i] = 0
        heapq.heapify(queue)
        while queue:
            d, u = heapq.heappop(queue)
            if d > distance[u]:
                continue
            if u < n:
                edges = [(n + j, cost[u][j]) for j in range(m)]
            else:
                edges = [(i, -cost[i][u - n]) for i in range(n) if flow[i][u - n]]
            for v, price in edges:
                reached = d + price + potential[u] - potential[v]
                if distance[v] is None or reached < distance[v]:
                    distance[v], came[v] = reached, u
                    heapq.heappush(queue, (reached, v))
        ends = [n + j for j in range(m) if room[j] and distance[n + j] is not None]
        end = min(ends, key=lambda v: distance[v] + potential[v])
        most = max(d for d in distance if d is not None)
        potential = [p + (most if d is None else d) for p, d in zip(potential, distance, strict=True)]
        path, v = [end], end
        while came[v] is not None:
            v = came[v]
            path.append(v)
        path.reverse()
        amount = min(left[path[0]], room[end - n])
        for u, v in zip(path, path[1:], strict=False):
            if u >= n:
                amount = min(amount, flow[v][u - n])
        for u, v in zip(path, path[1:], strict=False):
            if u < n:
                flow[u][v - n] += amount
            else:
                flow[v][u - n] -= amount
        left[path[0]] -= amount
        room[end - n] -= amount
    return flow


def block_transfers(blocks: dict[int, list[tuple[int, int]]], capacities: list[int]) -> dict[int, int]:
    """New shard of every block: ``blocks[old shard]`` lists (block, bytes) in stored order.

    Staying costs nothing and moving one a byte, so the flow ships what exceeds
    the new capacities and no more.  Blocks leave from the end of a shard, so
    that few files are touched; the block that straddles an amount goes where
    the larger part of it belongs.
    """
    old = sorted(blocks)
    supply = [sum(size for _, size in blocks[s]) for s in old]
    cost = [[0 if s == j else 1 for j in range(len(capacities))] for s in old]
    flow = minimum_cost_flow(supply, capacities, cost)
    placed: dict[int, int] = {}
    owed = [0.0] * len(capacities)
    for i, s in enumerate(old):
        # First what stays, then the other shards in order; each as far as its bytes reach.
        order = sorted(range(len(capacities)), key=lambda j: (j != s, j))
        wanted = [(j, flow[i][j]) for j in order if flow[i][j]]
        for j, amount in wanted:
            owed[j] += amount
        at = 0
        for block, size in blocks[s]:
            while at < len(wanted) - 1 and owed[wanted[at][0]] < size / 2:
                at += 1
            placed[block] = wanted[at][0] if wanted else s
            owed[placed[block]] -= size
    return placed


def reshard(docs: DataFrame, *, old_shards: int = 6, new_shards: int = 8) -> DataFrame:
    """``docs`` stored in ``old_shards``, then moved to ``new_shards`` of equal capacity.

    Returns ``doc_id, text, size, block, shard, slot``, read back from the files
    of the new layout.  Size is the bytes of the text, null as none, plus 1.
    Equal texts are in one block, hence in one shard, unless their block alone
    fills more than a quarter of a shard: it is cut by doc_id.  Files are cut by
    doc_id too, so that none is more than a task should hold.  ``slot`` counts
    from 0 in each shard, in order of block, file and doc_id; rows of one doc_id
    are in the order of their text's hash.  Files without a moved block stay as
    they are; of the others, moved blocks are written under their new shard and
    the rest again under the old one.  Other columns are not stored.
    """
    spark = docs.sparkSession
    cells, group_cells = old_shards * BLOCKS_A_SHARD, BLOCKS_A_SHARD // FILES_A_SHARD
    groups = old_shards * FILES_A_SHARD
    sized = docs.select("doc_id", "text", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"))
    sized = sized.withColumn("cell", F.pmod(F.xxhash64("text"), F.lit(cells)).cast("int"))
    of_cell = [0] * cells
    for r in sized.groupBy("cell").agg(F.sum("size").alias("bytes")).collect():
        of_cell[r["cell"]] = r["bytes"]
    total = sum(of_cell)

    # Cells too large to move as one block, and groups too large for one file.
    most, file_bytes = max(1, total // (4 * new_shards)), max(1, total // (4 * shuffle_partitions(spark)))
    cuts = [max(1, -(-size // most)) for size in of_cell]
    files = [max(1, -(-sum(of_cell[g * group_cells : (g + 1) * group_cells]) // file_bytes)) for g in range(groups)]
    dealt = (
        sized.withColumn("cut", F.pmod(F.xxhash64(F.lit("cut"), "doc_id"), _looked_up(cuts, "cell")))
        .withColumn("block", (F.col("cell") + F.lit(cells) * F.col("cut")).cast("int"))
        .withColumn("group", F.floor(F.col("cell") / F.lit(group_cells)).cast("int"))
        .withColumn("file", F.pmod(F.xxhash64(F.lit("file"), "doc_id"), _looked_up(files, "group")).cast("int"))
        .drop("cell", "cut")
        .repartition(shuffle_partitions(spark), "group", "file")
    )
    order = Window.partitionBy("group", "file", "block").orderBy("doc_id", F.xxhash64("text"))
    old = scratch_path(spark, "old-shards")
    dealt.withColumn("place", F.row_number().over(order) - 1).write.option("compression", "zstd").partitionBy("group").parquet(old)
    stored = spark.read.schema("doc_id long, text string, size long, block int, file int, place int, group int").parquet(old)

    # Sizes of the stored blocks, the flow, and from it every block's new shard.
    pieces = stored.groupBy("group", "block", "file").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    pieces = materialize(pieces, "pieces")
    blocks: dict[int, list[tuple[int, int]]] = {s: [] for s in range(old_shards)}
    home = {}
    for r in pieces.groupBy("group", "block").agg(F.sum("bytes").alias("bytes")).orderBy("group", "block").collect():
        home[r["block"]] = r["group"]
        blocks[r["group"] // FILES_A_SHARD].append((r["block"], r["bytes"]))
    base, over = divmod(total, new_shards)
    placed = block_transfers(blocks, [base + (j < over) for j in range(new_shards)])
    plan = spark.createDataFrame(list(placed.items()), "block int, shard int")
    in_order = Window.partitionBy("shard").orderBy("group", "block", "file").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.join(F.broadcast(plan), "block").withColumn("first", F.coalesce(F.sum("rows").over(in_order), F.lit(0)))
    starts = materialize(starts.select("block", "file", "shard", "first"), "starts")

    # Only files that hold a moved block are rewritten.
    touched = sorted({g for block, g in home.items() if placed[block] != g // FILES_A_SHARD})
    columns = ["doc_id", "text", "size", "block", "file", "place"]
    new = scratch_path(spark, "new-shards")
    moving = stored.filter(F.col("group").isin(touched)).join(F.broadcast(plan), "block")
    moving.select(*columns, "shard").write.option("compression", "zstd").partitionBy("shard").parquet(new)
    rewritten = spark.read.schema("doc_id long, text string, size long, block int, file int, place int, shard int").parquet(new)
    current = stored.filter(~F.col("group").isin(touched)).select(*columns).unionByName(rewritten.select(*columns))
    return current.join(starts, ["block", "file"]).select(
        "doc_id", "text", "size", "block", "shard", (F.col("first") + F.col("place")).alias("slot")
    )


def _looked_up(values: list[int], index: str):
    return F.get(F.array(*map(F.lit, values)), F.col(index))
