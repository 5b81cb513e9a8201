"""Connected components of an undirected graph, by alternating stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velotide.sources.scratch import materialize


# Distinct edges that one task takes at once (16 bytes each, some 100 while it works).
_EDGES_OF_A_TASK = 1 << 18


def connected_components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``, component its smallest node.

    Each round hangs larger neighbours, then smaller ones, on the smallest
    neighbour of a node; connectivity is kept and stars remain when nothing
    changes.  A node's neighbours are never gathered: every step is a minimum
    with a partial aggregate, written down so that the equi-join with it is one
    that adaptive execution can split.
    Edges with a null end and loops are ignored.  Rounds are written to the
    shared folder, so no lineage grows.  Few edges are taken by one task.
    """
    current = materialize(
        edges.filter(F.col("a") != F.col("b"))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    before = _summary(current)
    if not before[0]:
        return current.select(F.col("b").alias("node"), F.col("a").alias("component"))
    if before[0] <= _EDGES_OF_A_TASK and {kind for _, kind in current.dtypes} == {"bigint"}:
        return materialize(_in_one_task(current), "components")
    for _ in range(max_rounds):
        current = materialize(_small_star(_large_star(current)), "stars")
        after = _summary(current)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    hubs = current.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return current.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(hubs)


def _summary(edges: DataFrame) -> tuple:
    """Equal for equal sets of edges, different otherwise but for hash collisions."""
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.hash("b", "a"))).first())


def _in_one_task(edges: DataFrame) -> DataFrame:
    """The same by minima over edges in memory: roots hang on smaller ones, and all nodes on their root's."""

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = [(b.column("a").to_numpy(), b.column("b").to_numpy()) for b in batches]
        if not columns:
            return
        a, b = (np.concatenate(c) for c in zip(*columns, strict=True))
        nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
        u, v = np.split(place, 2)
        root = np.arange(len(nodes))
        while True:
            x, y, after = root[u], root[v], root.copy()
            np.minimum.at(after, x, y)
            np.minimum.at(after, y, x)
            after = after[after]
            if np.array_equal(after, root):
                break
            root = after
        for start in range(0, len(nodes), 8192):
            part = slice(start, start + 8192)
            yield pa.RecordBatch.from_arrays([pa.array(nodes[part]), pa.array(nodes[root[part]])], ["node", "component"])

    return edges.coalesce(1).mapInArrow(joined, "node long, component long")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    least = materialize(both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m")), "least")
    return (
        both.join(least, "u")
        .filter(F.col("v") > F.col("u"))
        .select(F.col("m").alias("a"), F.col("v").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Every edge (a, b) has a < b: seen from b, a is a smaller neighbour."""
    least = materialize(edges.groupBy("b").agg(F.min("a").alias("m")), "least")
    joined = edges.join(least, "b")
    return (
        joined.select(F.col("m").alias("a"), "b")
        .unionByName(joined.filter(F.col("a") != F.col("m")).select(F.col("m").alias("a"), F.col("a").alias("b")))
        .distinct()
    )
