"""Nearest neighbours by inner product: randomly rotated one-bit codes, reranked within error bounds.

A vector's offset from the centre of its block is turned by a random rotation
and kept as one sign a dimension, packed, with three scalars: its length, how
well the signs point its way, and its product with the centre.  Signs and
scalars estimate the inner product with a query, and say how far off the estimate may
be.  Only vectors whose upper bound reaches a query's k-th best score so far are
compared exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from velotide.llm.common import rows_of
from velotide.llm.embedding_join import usable_vectors
from velotide.sources.scratch import materialize

# Vectors of one block, and bytes of query vectors that tasks hold at a time;
# so many are broadcast, never more.
BLOCK_VECTORS = 2048
QUERY_BYTES = 16 << 20
# Standard errors allowed for: the share of neighbours beyond is below 1e-4.
ERRORS = 4.0
SEED = 2026

# Room for single precision in the estimate, relative to the lengths.
_SLACK = 1e-5
# Pairs compared at once, and queries that meet a block at once.
_PAIRS = 1 << 16
_QUERIES = 1024


@lru_cache(maxsize=4)
def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dim]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def encode(vectors: np.ndarray, seed: int = SEED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Centre, packed signs and scalars ``(length, agreement, with centre)`` of a block."""
    dim = vectors.shape[1]
    centre = vectors.mean(axis=0)
    offset = vectors - centre
    length = np.sqrt((offset * offset).sum(axis=1))
    turned = (offset / np.where(length > 0, length, 1)[:, None]) @ rotation(dim, seed)
    agreement = np.abs(turned).sum(axis=1) / np.sqrt(dim)
    scalars = np.stack([length, np.where(length > 0, agreement, 1.0), vectors @ centre], axis=1)
    return centre, np.packbits(turned > 0, axis=1), scalars


def estimate(
    queries: np.ndarray, centre: np.ndarray, signs: np.ndarray, scalars: np.ndarray, errors: float = ERRORS, seed: int = SEED
) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products of all queries with all coded vectors, and how far they may be off."""
    dim = queries.shape[1]
    offset = queries - centre
    reach = np.sqrt((offset * offset).sum(axis=1))
    bits = np.unpackbits(signs, axis=1, count=dim).astype(np.float32) * 2 - 1
    along = (offset @ rotation(dim, seed)).astype(np.float32) @ bits.T / np.float32(np.sqrt(dim))
    length, agreement, with_centre = scalars.T
    constant = queries @ centre - centre @ centre
    middle = along * (length / agreement)[None, :] + with_centre[None, :] + constant[:, None]
    doubt = np.sqrt(np.maximum(0.0, 1 - agreement * agreement)) / agreement * errors / np.sqrt(max(1, dim - 1)) + _SLACK
    return middle, reach[:, None] * (length * doubt)[None, :]


def coded_blocks(usable: DataFrame, block_vectors: int = BLOCK_VECTORS, seed: int = SEED) -> DataFrame:
    """Blocks of ``usable(vec_id, body)`` in the order tasks read them: nothing is shuffled.

    A block holds vectors of one length.
    """

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[tuple[int, bytes]]] = {}
        for ids, bodies in rows_of(batches, "vec_id", "body"):
            for row in zip(ids, bodies, strict=True):
                rows = waiting.setdefault(len(row[1]) // 8, [])
                rows.append(row)
                if len(rows) == block_vectors:
                    yield block(rows)
                    rows.clear()
        yield from (block(rows) for rows in waiting.values() if rows)

    def block(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
        body = b"".join(r[1] for r in rows)
        vectors = np.frombuffer(body, np.float64).reshape(len(rows), -1)
        centre, signs, scalars = encode(vectors, seed)
        packed = [np.array([r[0] for r in rows], np.int64), centre, signs, scalars]
        columns = [pa.array([vectors.shape[1]], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in packed)]
        return pa.RecordBatch.from_arrays([*columns, pa.array([body], pa.binary())], ["dim", "ids", "centre", "signs", "scalars", "vectors"])

    return usable.mapInArrow(coded, "dim int, ids binary, centre binary, signs binary, scalars binary, vectors binary")


def query_groups(usable: DataFrame, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """``group, dim, ids, vectors``: queries of one length packed into rows of ``query_bytes`` at most (or one query)."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[tuple[int, bytes]]] = {}
        for ids, bodies in rows_of(batches, "vec_id", "body"):
            for row in zip(ids, bodies, strict=True):
                rows = waiting.setdefault(len(row[1]), [])
                if rows and (len(rows) + 1) * len(row[1]) > query_bytes:
                    yield group(rows)
                    rows.clear()
                rows.append(row)
        yield from (group(rows) for rows in waiting.values() if rows)

    def group(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
        ids = np.array([r[0] for r in rows], np.int64)
        columns = [pa.array([len(rows[0][1]) // 8], pa.int32()), pa.array([ids.tobytes()], pa.binary()), pa.array([b"".join(r[1] for r in rows)], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["dim", "ids", "vectors"])

    # One partition for each group's worth of bytes, so that groups fill.
    size = usable.agg(F.sum(F.length("body"))).first()[0] or 0
    dealt = usable.repartition(max(1, -(-size // query_bytes)), F.xxhash64("vec_id", "body"))
    return dealt.mapInArrow(packed, "dim int, ids binary, vectors binary").withColumn("group", F.monotonically_increasing_id())


class _Best:
    """The k best scores of each query of a group, over the blocks one task has seen."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, k: int):
        self.ids, self.queries, self.k = ids, queries, k
        self.by_dimension = np.ascontiguousarray(queries.T)
        self.found = np.zeros((len(ids), k), np.int64)
        self.scores = np.full((len(ids), k), -np.inf)

    def meet(self, part: slice, ids: np.ndarray, vectors: np.ndarray, middle: np.ndarray, doubt: np.ndarray) -> None:
        """Queries of ``part`` against a block, by their estimates."""
        own = self.ids[part, None] == ids[None, :]
        low = np.where(own, -np.inf, middle - doubt)
        least = self.scores[part, -1]
        if len(ids) > self.k:
            least = np.maximum(least, np.partition(low, -self.k, axis=1)[:, -self.k])
        query, place = np.nonzero((middle + doubt >= least[:, None]) & ~own)
        query += part.start
        exact = np.empty(len(query))
        by_dimension = np.ascontiguousarray(vectors.T)
        for start in range(0, len(query), _PAIRS):
            here = slice(start, start + _PAIRS)
            total = np.zeros(len(query[here]))
            # Summed in the order of the dimensions, so equal vectors score alike everywhere.
            for q, v in zip(self.by_dimension, by_dimension, strict=True):
                total += q[query[here]] * v[place[here]]
            exact[here] = total
        better = exact >= self.scores[query, -1]
        query, place, exact = query[better], place[better], exact[better]
        for q in np.unique(query).tolist():
            first, last = np.searchsorted(query, [q, q + 1])
            scores = np.concatenate((self.scores[q], exact[first:last]))
            found = np.concatenate((self.found[q], ids[place[first:last]]))
            order = np.lexsort((found, -scores))[: self.k]
            self.scores[q], self.found[q] = scores[order], found[order]

    def rows(self, group: int) -> pa.RecordBatch:
        query, place = np.nonzero(np.isfinite(self.scores))
        columns = [np.full(len(query), group), query, self.ids[query], self.found[query, place], self.scores[query, place]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["group", "place", "query_id", "vec_id", "score"])


def nearest(
    rows: DataFrame,
    queries: DataFrame,
    *,
    k: int = 20,
    id_column: str = "vec_id",
    vector: str = "embedding",
    errors: float = ERRORS,
    query_bytes: int = QUERY_BYTES,
    block_vectors: int = BLOCK_VECTORS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for every row of ``queries`` the ``k`` rows of largest inner product.

    Candidates are all ``rows`` of another id and the same number of dimensions.
    Scores are exact, in double precision; equal ones are ranked by ascending
    vec_id.  A neighbour is missed only if its estimate is off by more than
    ``errors`` standard errors.  Null ids and vectors that are null, empty, zero
    or hold a null or non-finite component take no part.  Every row counts, also
    if ids repeat: each query row has its own ranks.  Queries go to the tasks in
    groups of ``query_bytes``; every task reads its blocks once for a group.
    """
    spark = rows.sparkSession
    blocks = materialize(coded_blocks(usable_vectors(rows, id_column, vector), block_vectors), "coded")
    groups = materialize(query_groups(materialize(usable_vectors(queries, id_column, vector), "queries"), query_bytes), "groups")
    found = None
    for number, (dim, members) in enumerate(_together(groups, query_bytes)):
        # At most query_bytes of vectors, or a single group.
        packed = groups.filter(F.col("group").isin(members)).orderBy("group").select("ids", "vectors").collect()
        bodies = [b"".join(bytes(row[c]) for row in packed) for c in ("ids", "vectors")]
        shared = spark.sparkContext.broadcast((number, dim, *bodies))
        met = materialize(_met(blocks.filter(F.col("dim") == dim), shared, k, errors), "met")
        shared.destroy()
        found = met if found is None else found.unionByName(met)
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    order = Window.partitionBy("group", "place").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _together(groups: DataFrame, query_bytes: int) -> Iterator[tuple[int, list[int]]]:
    """Groups that are sent in one go: of one length and ``query_bytes`` at most together.

    Only their sizes reach the driver here.
    """
    sizes = groups.select("dim", "group", F.length("vectors").alias("size")).collect()
    members, total, dim = [], 0, None
    for row in sorted(sizes):
        if members and (row["dim"] != dim or total + row["size"] > query_bytes):
            yield dim, members
            members, total = [], 0
        dim, total = row["dim"], total + row["size"]
        members.append(row["group"])
    if members:
        yield dim, members


def _met(blocks: DataFrame, shared, k: int, errors: float) -> DataFrame:
    """The k best of every task for each query of the group."""

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, dim, ids, bodies = shared.value
        queries = np.frombuffer(bodies, np.float64).reshape(-1, dim)
        best = _Best(np.frombuffer(ids, np.int64), queries, k)
        for vec_ids, centre, signs, scalars, vectors in _blocks(batches, dim):
            # So many queries at a time that the estimates of a block stay small.
            for start in range(0, len(queries), _QUERIES):
                part = slice(start, min(start + _QUERIES, len(queries)))
                middle, doubt = estimate(queries[part], centre, signs, scalars, errors)
                best.meet(part, vec_ids, vectors, middle, doubt)
        yield best.rows(group)

    return blocks.mapInArrow(met, "group long, place long, query_id long, vec_id long, score double")


def _blocks(batches: Iterator[pa.RecordBatch], dim: int):
    for batch in batches:
        for i in range(batch.num_rows):
            ids, centre, signs, scalars, vectors = (
                np.frombuffer(batch.column(c)[i].as_buffer(), kind)
                for c, kind in (("ids", np.int64), ("centre", np.float64), ("signs", np.uint8), ("scalars", np.float64), ("vectors", np.float64))
            )
            yield ids, centre, signs.reshape(len(ids), -1), scalars.reshape(-1, 3), vectors.reshape(-1, dim)
