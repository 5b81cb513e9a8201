"""Exact range join of vectors by cosine: pivots, boundary replication, independent cells.

On unit vectors a cosine of at least c is a distance of at most
r = sqrt(2 - 2c).  A vector lives in the cell of its nearest pivot, and is
copied to every cell that may hold a neighbour of it: by the triangle
inequality, those whose pivot p has d(x, p) <= radius(p) + r, and by the
hyperplane between two pivots, those it is no farther than r from.  A link is
the same from both ends, so of any two blocks only one is visited by the other.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velotide.llm.common import rows_of
from velotide.llm.components import connected_components
from velotide.sources.scratch import materialize

# Vectors of a cell aimed at and the most pivots, which are broadcast.
CELL_VECTORS = 4096
MOST_PIVOTS = 4096
# Members of a cell that a task holds at once, and guests it lets pass by them.
BLOCK_VECTORS = 4096
GUESTS_IN_A_RUN = 1 << 17
# Guests that members are compared with at once.
GUESTS_AT_ONCE = 128

# Room for rounding of single and double precision sums when candidates are
# looked for; what is found is decided in double precision.
_SLACK = 1e-4


def _unit(vectors: list) -> np.ndarray:
    """Rows of length one in double precision."""
    x = np.array(vectors, np.float64)
    largest = np.abs(x).max(axis=1, keepdims=True)
    x /= largest
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def packed_vectors(rows: DataFrame, id_column: str, vector: str) -> DataFrame:
    """``vec_id, body``, a row a row: a vector with a direction as doubles in one binary.

    The body is null where the id is, and where the vector is null, empty, zero
    or holds a null or non-finite component.
    """

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vectors = batch.column("vec_id"), batch.column("vector")
            ends = np.cumsum(pc.fill_null(pc.list_value_length(vectors), 0).to_numpy())
            starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
            # Null components become NaN.  Zeros of both signs are one number, so equal vectors are equal bytes.
            x = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64) + 0.0
            odd, some = (np.concatenate(([0], np.cumsum(which))) for which in (~np.isfinite(x), x != 0))
            usable = (odd[ends] == odd[starts]) & (some[ends] > some[starts]) & ids.is_valid().to_numpy(zero_copy_only=False)
            bodies = [x[i:j].tobytes() if u else None for i, j, u in zip(starts, ends, usable, strict=True)]
            yield pa.RecordBatch.from_arrays([ids, pa.array(bodies, pa.binary())], ["vec_id", "body"])

    slim = rows.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector).alias("vector"))
    return slim.mapInArrow(packed, "vec_id long, body binary")


def usable_vectors(rows: DataFrame, id_column: str, vector: str) -> DataFrame:
    """The rows of ``packed_vectors`` that have a body."""
    return packed_vectors(rows, id_column, vector).filter("body IS NOT NULL")


def _matrix(bodies: list[bytes]) -> np.ndarray:
    return _unit(np.frombuffer(b"".join(bodies), np.float64).reshape(len(bodies), -1))


def choose_pivots(distinct: DataFrame, rows: int) -> np.ndarray:
    """Vectors drawn by the hash of their content: one for each cell, MOST_PIVOTS at most.

    Dense regions hold more of them, so their cells are smaller.
    """
    wanted = min(MOST_PIVOTS, max(1, -(-rows // CELL_VECTORS)))
    drawn = distinct.select("body", F.xxhash64("body").alias("h")).orderBy("h", "body").limit(wanted).collect()
    return _matrix([bytes(r["body"]) for r in drawn])


def _copies(near: np.ndarray, home: np.ndarray, gaps: np.ndarray, radius: np.ndarray, r: float) -> np.ndarray:
    """Cells each vector must be seen in; ``near`` are cosines with the pivots."""
    n = len(near)
    distance = np.sqrt(np.maximum(0.0, 2 - 2 * near))
    by_ball = distance <= radius[None, :] + r + _SLACK
    lead = near[np.arange(n), home][:, None] - near
    by_plane = lead <= (r + _SLACK) * gaps[home]
    return by_ball & by_plane


def _homes(distinct: DataFrame, pivots) -> DataFrame:
    """Each vector with its nearest pivot and the distance to it."""

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, bodies, copies in rows_of(batches, "vec_id", "body", "copies"):
            near = _matrix(bodies) @ pivots.value.T
            home = near.argmax(axis=1)
            far = np.sqrt(np.maximum(0.0, 2 - 2 * near[np.arange(len(home)), home]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(bodies, pa.binary()), pa.array(copies, pa.int64()), pa.array(home.astype(np.int32)), pa.array(far)],
                ["vec_id", "body", "copies", "home", "far"],
            )

    return distinct.mapInArrow(nearest, "vec_id long, body binary, copies long, home int, far double")


def _visits(
    near: np.ndarray, turn: np.ndarray, home: np.ndarray, gaps: np.ndarray, blocks: np.ndarray, radius: np.ndarray, r: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``who, cell, block``: the blocks in which each vector is a guest, its own not among them.

    Blocks are numbered through.  One visits those above it at an odd distance
    and those below it at an even one, so every block has about half of the
    others as guests.
    """
    first = np.cumsum(blocks) - blocks
    who, cell = np.nonzero(_copies(near, home, gaps, radius, r) & (blocks > 0)[None, :])
    times = blocks[cell]
    block = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    who, cell = np.repeat(who, times), np.repeat(cell, times)
    own, other = (first[home] + turn % blocks[home])[who], first[cell] + block
    visited = np.where(own < other, (other - own) % 2 == 1, (own > other) & ((own - other) % 2 == 0))
    return who[visited], cell[visited], block[visited]


def _turns(ids: np.ndarray) -> np.ndarray:
    """By what vectors are dealt to the blocks and runs of a cell."""
    return (ids.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64)


def _guests(at_home: DataFrame, pivots, blocks: np.ndarray, radius: np.ndarray, r: float) -> dict[int, int]:
    """How many guests the blocks of each cell have together; a task adds one row a cell."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gaps = np.sqrt(np.maximum(0.0, 2 - 2 * (pivots.value @ pivots.value.T)))
        guests = np.zeros(len(radius), np.int64)
        for ids, bodies, homes in rows_of(batches, "vec_id", "body", "home"):
            near, turn = _matrix(bodies) @ pivots.value.T, _turns(np.array(ids, np.int64))
            _, cell, _ = _visits(near, turn, np.array(homes), gaps, blocks, radius, r)
            guests += np.bincount(cell, minlength=len(radius))
        cells = np.flatnonzero(guests)
        yield pa.RecordBatch.from_arrays([pa.array(cells.astype(np.int32)), pa.array(guests[cells])], ["cell", "n"])

    counts = at_home.select("vec_id", "body", "home").mapInArrow(counted, "cell int, n long")
    return {x["cell"]: x["n"] for x in counts.groupBy("cell").agg(F.sum("n").alias("n")).collect()}


def _dealt(at_home: DataFrame, pivots, plan, r: float) -> DataFrame:
    """Members in their block of their cell, guests at the blocks they visit.

    Members come once for every run of guests; guests of a block are dealt to its runs.
    """

    def copied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, radius, runs = plan.value
        gaps = np.sqrt(np.maximum(0.0, 2 - 2 * (pivots.value @ pivots.value.T)))
        names = ["cell", "block", "run", "guest", "vec_id", "copies", "body"]
        for ids, bodies, copies, homes in rows_of(batches, "vec_id", "body", "copies", "home"):
            ids, home, copies = np.array(ids, np.int64), np.array(homes), np.array(copies, np.int64)
            near, turn = _matrix(bodies) @ pivots.value.T, _turns(ids)
            bodies = np.array(bodies, object)
            who, cell, block = _visits(near, turn, home, gaps, blocks, radius, r)
            each = runs[home]
            member = np.repeat(np.arange(len(ids)), each)
            run = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
            at = np.concatenate((who, member))
            columns = [
                np.concatenate((cell, home[member])).astype(np.int32),
                np.concatenate((block, (turn % blocks[home])[member])).astype(np.int32),
                np.concatenate((turn[who] % runs[cell], run)).astype(np.int32),
                np.concatenate((np.ones(len(who), bool), np.zeros(len(member), bool))),
                ids[at],
                copies[at],
            ]
            for start in range(0, len(at), 8192):
                part = slice(start, start + 8192)
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(c[part]) for c in columns), pa.array(bodies[at[part]].tolist(), pa.binary())], names
                )

    return at_home.mapInArrow(copied, "cell int, block int, run int, guest boolean, vec_id long, copies long, body binary")


class _Block:
    """Members of one block, and what is known of their links."""

    def __init__(self, ids: np.ndarray, copies: np.ndarray, vectors: np.ndarray, cosine: float):
        self.ids, self.copies, self.exact, self.cosine = ids, copies, vectors, cosine
        self.single = vectors.astype(np.float32)
        self.links = np.zeros(len(ids), np.int64)
        self.group = np.arange(len(ids))
        self.edges: list[tuple[int, int]] = []
        self.guests: list[tuple[np.ndarray, np.ndarray]] = []

    def _linked(self, vectors: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places of members and of the vectors they are linked with, by the latter's."""
        for first in range(0, len(vectors), GUESTS_AT_ONCE):
            some = vectors[first : first + GUESTS_AT_ONCE]
            near = (some.astype(np.float32) @ self.single.T).ravel()
            found = np.flatnonzero(near >= self.cosine - _SLACK)
            linked = near[found] >= self.cosine + _SLACK
            column, row = np.divmod(found, len(self.ids))
            close = np.flatnonzero(~linked)
            for start in range(0, len(close), 1 << 16):
                at = close[start : start + (1 << 16)]
                linked[at] = np.einsum("ij,ij->i", self.exact[row[at]], some[column[at]]) >= self.cosine
            yield row[linked], first + column[linked]

    def _join(self, row: np.ndarray, column: np.ndarray, ids: np.ndarray) -> None:
        """Edges to each linked vector from one member of every group that it links."""
        cuts = [0, *(np.flatnonzero(column[1:] != column[:-1]) + 1).tolist(), len(column)]
        for start, end in zip(cuts, cuts[1:], strict=False) if len(column) else ():
            members, j = row[start:end], column[start]
            groups, first = np.unique(self.group[members], return_index=True)
            self.edges += [(int(self.ids[members[k]]), int(ids[j])) for k in first.tolist()]
            if len(groups) > 1:
                self.group[np.isin(self.group, groups)] = groups[0]

    def meet_members(self) -> None:
        for row, column in self._linked(self.exact):
            earlier = row < column
            row, column = row[earlier], column[earlier]
            np.add.at(self.links, row, self.copies[column])
            np.add.at(self.links, column, self.copies[row])
            self._join(row, column, self.ids)

    def meet(self, ids: np.ndarray, copies: np.ndarray, vectors: np.ndarray) -> None:
        of_guests = np.zeros(len(ids), np.int64)
        for row, column in self._linked(vectors):
            np.add.at(self.links, row, copies[column])
            np.add.at(of_guests, column, self.copies[row])
            self._join(row, column, ids)
        if of_guests.any():
            some = np.flatnonzero(of_guests)
            self.guests.append((ids[some], of_guests[some]))

    def rows(self) -> pa.RecordBatch:
        """Spanning edges, and with b null a number of rows linked to a."""
        some = np.flatnonzero(self.links)
        counted = [(self.ids[some], self.links[some]), *self.guests]
        ends, links = (np.concatenate(x) for x in zip(*counted, strict=True))
        a = [e[0] for e in self.edges] + ends.tolist()
        b = [e[1] for e in self.edges] + [None] * len(ends)
        n = [0] * len(self.edges) + links.tolist()
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, b, n)], ["a", "b", "links"])


def links_of_cells(distinct: DataFrame, rows: int, cosine: float) -> DataFrame:
    """``(a, b, links)``: edges that connect all linked vectors and, with b null, how many rows of a block link to a.

    ``distinct(vec_id, body, copies)`` has equal vectors folded into one row, all
    of one length, with a vec_id of its own; there are ``rows`` of them.
    """
    spark = distinct.sparkSession
    r = math.sqrt(max(0.0, 2 - 2 * cosine))
    pivots = choose_pivots(distinct, rows)
    shared = spark.sparkContext.broadcast(pivots)
    at_home = materialize(_homes(distinct, shared), "homes")
    sizes = {x["home"]: x for x in at_home.groupBy("home").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("far")).collect()}
    members = np.array([sizes[p]["n"] if p in sizes else 0 for p in range(len(pivots))], np.int64)
    radius = np.array([sizes[p]["far"] if p in sizes else -9.0 for p in range(len(pivots))])
    blocks = -(-members // BLOCK_VECTORS)
    guests = _guests(at_home, shared, blocks, radius, r)
    runs = np.array([max(1, -(-guests.get(p, 0) // (max(1, blocks[p]) * GUESTS_IN_A_RUN))) for p in range(len(pivots))], np.int64)
    plan = spark.sparkContext.broadcast((blocks, radius, runs))
    dealt = _dealt(at_home, shared, plan, r).repartition("cell", "block", "run")
    dealt = dealt.sortWithinPartitions("cell", "block", "run", "guest")

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, block, members = None, None, []

        def gathered() -> _Block:
            ids, copies, bodies = zip(*members, strict=True)
            members.clear()
            found = _Block(np.concatenate(ids), np.concatenate(copies), _matrix([x for b in bodies for x in b]), cosine)
            if key[2] == 0:
                found.meet_members()
            return found

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)], axis=1).astype(np.int64)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for first, last in zip(cuts, cuts[1:], strict=False):
                part = batch.slice(first, last - first)
                vec, copies, body = part.column(4).to_numpy(), part.column(5).to_numpy(), part.column(6).to_pylist()
                place, guest = tuple(keys[first][:3].tolist()), bool(keys[first][3])
                if place != key:
                    if members:
                        block = gathered()
                    if block is not None:
                        yield block.rows()
                    key, block = place, None
                if not guest:
                    members.append((vec, copies, body))
                    continue
                if members:
                    block = gathered()
                if block is not None:
                    block.meet(vec, copies, _matrix(body))
        if members:
            block = gathered()
        if block is not None:
            yield block.rows()

    return dealt.mapInArrow(joined, "a long, b long, links long")


def near_vectors(
    rows: DataFrame, *, cosine: float = 0.9, id_column: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """``vec_id, n_links, component_id, kept``, one row per row of ``rows``.

    ``n_links`` counts the other rows whose cosine is at least ``cosine``,
    ``component_id`` is the smallest id that links reach, and rows with that id
    are kept.  Unusable vectors (see ``packed_vectors``) link with nothing and
    are kept.  Rows that share an id are rows of their own: each has the links
    of its vector, and nothing follows from the common id.  Vectors of different
    lengths never link; every length that occurs twice or more is joined by
    itself.  ``cosine`` is above 0; other columns are ignored.
    """
    # Rows get their numbers when they are written; equal vectors have that of one of them.
    packed = packed_vectors(rows, id_column, vector).withColumn("row", F.monotonically_increasing_id())
    vectors = materialize(packed, "vectors")
    classes = vectors.filter("body IS NOT NULL").groupBy("body").agg(
        F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("copies"), F.min("row").alias("vertex")
    )
    classes = materialize(classes, "classes")
    length = F.octet_length("body")
    lengths = classes.groupBy(length.alias("length")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").orderBy("length").collect()
    found = classes.sparkSession.createDataFrame([], "a long, b long, links long")
    for row in lengths:
        joined = classes.filter(length == row["length"]).select(F.col("vertex").alias("vec_id"), "body", "copies")
        found = found.unionByName(materialize(links_of_cells(joined, row["n"], cosine), "links"))
    component = connected_components(found.filter("b IS NOT NULL").select("a", "b")).withColumnRenamed("node", "vertex")
    linked = found.filter("b IS NULL").groupBy(F.col("a").alias("vertex")).agg(F.sum("links").alias("links"))
    facts = classes.select("vertex", "first", "copies").join(linked, "vertex", "left").join(component, "vertex", "left")
    facts = materialize(facts.withColumn("component", F.coalesce("component", "vertex")), "facts")
    least = materialize(facts.groupBy("component").agg(F.min("first").alias("least")), "least")
    of_vertex = facts.join(least, "component").select(
        "vertex", "least", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links")
    )
    # Only vectors that come twice are looked up by their bytes.
    repeated = materialize(classes.filter("copies > 1").select("body", F.col("vertex").alias("same")), "repeated")
    numbered = vectors.join(repeated, "body", "left").select("vec_id", F.coalesce("same", "row").alias("vertex"))
    return numbered.join(of_vertex, "vertex", "left").select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("least", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.col("least"), F.lit(True)).alias("kept"),
    )
