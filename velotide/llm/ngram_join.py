"""N-gram Jaccard join: rare-first prefixes, then length, positional and suffix filters.

The grams of a document are ordered by how often they occur in all documents,
rarest first.  Two sets that are similar enough share a gram among their first
few, so only those prefixes are joined.  Candidates of one prefix gram are tied
to one hub each before anything else where only groups are wanted, then to their
neighbours in it, and what these do not connect is compared pair by pair; for all
links every pair is.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import ExitStack

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from velotide.llm.common import octets, rows_of
from velotide.llm.components import connected_components
from velotide.llm.gram_sets import GramSets
from velotide.sources.scratch import materialize, materialized

# Cells of the frequency table that orders grams: a power of two, and the size
# of what is broadcast.  The order only has to be the same for all documents;
# that grams share a cell costs candidates, never results.
FREQUENCY_CELLS = 1 << 16

# Involved documents up to which their places go to every executor (40 bytes
# each); beyond that texts are shuffled to them.
MOST_SENT_ROWS = 1 << 20

# Rows of one gram up to which a single window looks for the hub.
_ROWS_OF_A_HUB = 100_000

# A set's parity sketch: 512 bits in 64-bit columns.
_SKETCH = [f"s{i}" for i in range(8)]
# Sets of more grams have a sketch of a bit a gram besides, of so many bits at most.
_GRAMS_OF_A_SKETCH = 512
_MOST_BITS = 1 << 18

# Gram hashes of a place (8 bytes each).
_GRAMS_IN_A_PLACE = 1 << 21
# Gram hashes of small components that share a place.
_GRAMS_SHARING = 1 << 17
# Pairs that are compared in one place.
_PAIRS_IN_A_PLACE = 1 << 18
# Rows of one gram on either side that meet in one place.
_ROWS_THAT_MEET = 4096
# Pairs of rows of one gram that meet without neighbours being compared before.
_PAIRS_MET_AT_ONCE = 1 << 20
# Bytes of sets in one batch on their way to their places.
_SENT_BYTES = 1 << 22
# Vertices a task remembers to have sent.
_REMEMBERED = 1 << 18

# Stands for a null doc_id while documents are looked up.
_NO_ID = -(1 << 63)


def _digest(grams: np.ndarray) -> int:
    """Signed 64-bit name of a set: equal sets are one vertex of the join."""
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(grams.tobytes()) if len(grams) else 0)))


def least_overlap(n_a, n_b, percent: int):
    """Fewest common grams of two sets of these sizes that link."""
    return -(-percent * (n_a + n_b) // (100 + percent))


def prefix_length(n: int, percent: int) -> int:
    """A linked partner shares one of so many rarest grams."""
    return n - -(-percent * n // 100) + 1


def parity(grams: np.ndarray) -> np.ndarray:
    """For each of 512 ranges of hashes whether it holds an odd number, as eight words.

    Sets that differ in d hashes have sketches that differ in d bits at most.
    """
    odd = (np.bincount((grams >> np.uint64(55)).astype(np.int64), minlength=512) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def long_parity(grams: np.ndarray) -> bytes | None:
    """As ``parity``, by the last bits of the hashes, for a set that 512 bits say little of.

    There are as many bits as grams, up to a power of two, so that different
    sets differ in more bits than a link allows.
    """
    if len(grams) <= _GRAMS_OF_A_SKETCH:
        return None
    bits = min(1 << (len(grams) - 1).bit_length(), _MOST_BITS)
    odd = np.bincount((grams & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def parity_difference(x: bytes, y: bytes) -> int:
    """Bits in which two long sketches differ, the longer one folded to the size of the other."""
    a, b = sorted((np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)), key=len)
    while len(b) > len(a):
        b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    return int(np.bitwise_count(a ^ b).sum())


def _body() -> Column:
    """A text's hash, which with the doc_id finds the text again, also where ids repeat."""
    return F.xxhash64("text").alias("body")


def document_sets(docs: DataFrame, words: int) -> tuple[DataFrame, np.ndarray]:
    """``members(doc_id, body, n_shingles, vertex, s0..s7, parity)`` and how many grams fall into each cell.

    Documents with equal sets have one vertex.  Both come from one reading of
    the texts; for the counts every task adds at most one row a cell.
    """
    names = ["doc_id", "body", "n_shingles", "vertex", *_SKETCH, "cell"]

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, counts = GramSets(words), np.zeros(FREQUENCY_CELLS, np.int64)

        def rows(n: int, parity=None, **columns):
            arrays = [pa.array(columns.get(c, [None] * n), pa.int64()) for c in names]
            return pa.RecordBatch.from_arrays([*arrays, pa.array(parity or [None] * n, pa.binary())], [*names, "parity"])

        for ids, bodies, texts in rows_of(batches, "doc_id", "body", "text"):
            found = sets(texts)
            counts += np.bincount(_cells(np.concatenate(found)), minlength=FREQUENCY_CELLS)
            sketches = np.array([parity(g) for g in found]).T
            yield rows(
                len(ids),
                doc_id=ids,
                body=bodies,
                n_shingles=[len(g) for g in found],
                vertex=list(map(_digest, found)),
                parity=list(map(long_parity, found)),
                **dict(zip(_SKETCH, sketches, strict=True)),
            )
        cells = np.flatnonzero(counts)
        for start in range(0, len(cells), 8192):
            part = cells[start : start + 8192]
            yield rows(len(part), n_shingles=counts[part], cell=part)

    slim = docs.select(F.col("doc_id").cast("long"), _body(), octets("text").alias("text"))
    schema = ", ".join([*[f"{c} long" for c in names], "parity binary"])
    both = materialize(slim.mapInArrow(scanned, schema), "sets-and-counts")
    totals = np.zeros(FREQUENCY_CELLS, np.int64)
    sums = both.filter("cell IS NOT NULL").groupBy("cell").agg(F.sum("n_shingles").alias("n"))
    for r in sums.collect():
        totals[r["cell"]] = r["n"]
    return both.filter("cell IS NULL").drop("cell"), totals


def _cells(grams: np.ndarray) -> np.ndarray:
    return (grams % np.uint64(FREQUENCY_CELLS)).astype(np.int64)


def prefixes(docs: DataFrame, words: int, percent: int, frequencies: np.ndarray) -> DataFrame:
    """``(gram, part, vertex, n, pos)``: the rarest grams of each set with their places.

    ``part`` is 0, or 1 and more where it splits a gram whose cell is so full
    that one task might not hold its rows.  A task sends equal sets once, as
    long as it remembers them.
    """
    spark = docs.sparkSession
    order = spark.sparkContext.broadcast(frequencies)
    schema = pa.schema([("gram", pa.int64()), ("part", pa.int32()), ("vertex", pa.int64()), ("n", pa.int32()), ("pos", pa.int32())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, counts, sent = GramSets(words), order.value, set()
        for (texts,) in rows_of(batches, "text"):
            chosen, vertices, sizes, lengths = [], [], [], []
            for grams in sets(texts):
                vertex = _digest(grams)
                if not len(grams) or vertex in sent:
                    continue
                if len(sent) > _REMEMBERED:
                    sent.clear()
                sent.add(vertex)
                often = counts[_cells(grams)]
                p = prefix_length(len(grams), percent)
                first = np.argpartition(often, p - 1) if p < len(grams) else np.arange(len(grams))
                if p < len(grams):  # ties at the edge belong to the order too
                    first = np.flatnonzero(often <= often[first[p - 1]])
                first = first[np.lexsort((grams[first], often[first]))][:p]
                chosen.append(grams[first])
                vertices.append(vertex)
                sizes.append(len(grams))
                lengths.append(len(first))
            if not chosen:
                continue
            grams = np.concatenate(chosen)
            vertex = np.repeat(np.array(vertices, np.int64), lengths)
            parts = counts[_cells(grams)] // _ROWS_OF_A_HUB
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(grams.view(np.int64)),
                    pa.array(np.where(parts > 0, 1 + (vertex & 0x7FFFFFFF) % (parts + 1), 0).astype(np.int32)),
                    pa.array(vertex),
                    pa.array(np.repeat(np.array(sizes, np.int32), lengths)),
                    pa.array(np.concatenate([np.arange(k, dtype=np.int32) for k in lengths])),
                ],
                schema=schema,
            )

    return docs.select(octets("text").alias("text")).mapInArrow(cut, "gram long, part int, vertex long, n int, pos int")


def _may_link(percent: int):
    """Length and positional filter on a shared gram of sides a and b."""
    n_a, n_b = F.col("n").cast("long"), F.col("n_b").cast("long")
    fewest = F.ceil(percent * (n_a + n_b) / F.lit(100 + percent))
    most = F.least("pos", "pos_b") + 1 + F.least(n_a - F.col("pos") - 1, n_b - F.col("pos_b") - 1)
    return (100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b)) & (most >= fewest)


def _sketches_may_link(percent: int):
    """Suffix filter: the sets may not differ in more grams than a link allows."""
    n = F.col("n").cast("long") + F.col("n_b").cast("long")
    differ = sum((F.bit_count(F.col(s).bitwiseXOR(F.col(f"{s}_b"))) for s in _SKETCH), F.lit(0))
    return differ <= n - 2 * F.ceil(percent * n / F.lit(100 + percent))


def long_sketches_may_link(pairs: DataFrame, vertices: DataFrame, percent: int) -> DataFrame:
    """Suffix filter of ``pairs(a, b)`` of long sets; pairs with a short one pass."""
    known = vertices.filter("parity IS NOT NULL").select("vertex", "n", "parity")
    side = lambda v: known.select(*[F.col(c).alias(v if c == "vertex" else f"{c}_{v}") for c in known.columns])

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for a, b, n_a, n_b, x, y in rows_of(batches, "a", "b", "n_a", "n_b", "parity_a", "parity_b"):
            kept = [
                x[i] is None
                or y[i] is None
                or parity_difference(x[i], y[i]) <= n_a[i] + n_b[i] - 2 * least_overlap(n_a[i], n_b[i], percent)
                for i in range(len(a))
            ]
            ends = [pa.array([v for v, k in zip(end, kept, strict=True) if k], pa.int64()) for end in (a, b)]
            yield pa.RecordBatch.from_arrays(ends, ["a", "b"])

    return pairs.join(side("a"), "a", "left").join(side("b"), "b", "left").mapInArrow(passed, "a long, b long")


def _pairs(rows: DataFrame) -> DataFrame:
    return rows.select(F.least("vertex", "vertex_b").alias("a"), F.greatest("vertex", "vertex_b").alias("b")).distinct()


def with_hub(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows of groups with several vertices, once each, next to the group's smallest vertex."""
    group = Window.partitionBy(*keys)
    hub = F.min(F.struct(F.col("vertex").alias("vertex_b"), F.col("n").alias("n_b"), F.col("pos").alias("pos_b")))
    return (
        rows.withColumn("hub", hub.over(group))
        .withColumn("last", F.max("vertex").over(group))
        .filter((F.col("hub.vertex_b") < F.col("last")) | (F.col("part") > 0))
        .drop("last")
        .distinct()  # within the groups: no further shuffle
    )


def hub_candidates(tied: DataFrame, percent: int) -> DataFrame:
    """Each vertex of a gram paired with its hub; hubs of a gram's parts with the least of them."""
    of_parts = tied.filter((F.col("part") > 0) & (F.col("vertex") == F.col("hub.vertex_b"))).drop("hub").distinct()
    both = tied.unionByName(with_hub(of_parts, "gram")).select("*", "hub.*")
    return _pairs(both.filter((F.col("vertex") != F.col("vertex_b")) & _may_link(percent)))


def neighbour_candidates(rows: DataFrame, percent: int) -> DataFrame:
    """Each vertex of a gram paired with the next one of another component, in an order of the gram's own.

    Every gram orders its vertices anew, so members of a family get a random
    partner for each gram they share: as many pairs as rows, not their square.
    """
    part = F.pmod(F.xxhash64("vertex"), F.ceil(F.col("met") / F.lit(_ROWS_OF_A_HUB)).cast("long"))
    order = Window.partitionBy("gram", "part").orderBy(F.xxhash64("gram", "vertex"), "vertex")
    following = F.lead(F.struct(*[F.col(c).alias(f"{c}_b") for c in ("vertex", "n", "pos", "component")])).over(order)
    both = rows.withColumn("part", part).withColumn("next", following).select("*", "next.*")
    return _pairs(both.filter((F.col("component") != F.col("component_b")) & _may_link(percent)))


def suffix_bound(a: np.ndarray, b: np.ndarray, cuts: np.ndarray) -> int:
    """At most so many common values: cells of the value range hold min(count, count) of them."""
    in_a = np.diff(np.searchsorted(a, cuts), prepend=0, append=len(a))
    in_b = np.diff(np.searchsorted(b, cuts), prepend=0, append=len(b))
    return int(np.minimum(in_a, in_b).sum())


def verified(docs: DataFrame, pairs: DataFrame, vertices: DataFrame, words: int, percent: int) -> DataFrame:
    """The linked ones of distinct ``pairs(a, b)`` of vertices, each compared once.

    Only sets of documents in a pair are gathered: their texts are read again,
    one document a vertex.  Vertices that pairs connect are compared in one
    place; where those are too many pairs for one, the pairs are cut into
    blocks, and where a block has too many grams, the range of hashes is cut and
    each part counts what is common there.  A gram travels once to every block
    that has a pair of its set.
    """
    of_vertex, keyed = _places(pairs, vertices)
    if of_vertex.count() <= MOST_SENT_ROWS:
        of_vertex = F.broadcast(of_vertex)
    named = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("doc_id"), _body(), octets("text").alias("text"))
    texts = named.join(of_vertex, ["doc_id", "body"])

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, sent = GramSets(words), set()

        def batch(rows: list) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [()] * 5
            return pa.RecordBatch.from_arrays(
                [*[pa.array(c, pa.int64()) for c in columns[:4]], pa.array(columns[4], pa.binary())],
                ["place", "block", "part", "vertex", "grams"],
            )

        for texts, vertices, places in rows_of(batches, "text", "vertex", "places"):
            rows, size = [], 0
            for grams, vertex, needed in zip(sets(texts), vertices, places, strict=True):
                if vertex in sent or _digest(grams) != vertex:
                    continue
                sent.add(vertex)
                for to in needed:
                    n = to["ranges"]
                    edges = np.searchsorted(grams, np.array([(i << 64) // n for i in range(1, n)], np.uint64))
                    pieces = np.split(grams, edges)
                    rows += [(to["place"], to["block"], i, vertex, g.tobytes()) for i, g in enumerate(pieces) if len(g)]
                    size += grams.nbytes
                    if size > _SENT_BYTES:
                        yield batch(rows)
                        rows, size = [], 0
            yield batch(rows)

    sets = texts.select("text", "vertex", "places").mapInArrow(
        gathered, "place long, block long, part long, vertex long, grams binary"
    )

    def compared(bodies: pa.Table, pairs: pa.Table) -> pa.Table:
        # Views of the Arrow buffers: no set is copied.
        found = {
            v: np.frombuffer(g.as_buffer(), np.uint64)
            for v, g in zip(bodies["vertex"].to_pylist(), bodies["grams"], strict=True)
        }
        none, counted = np.empty(0, np.uint64), []
        names = ["a", "b", "n_a", "n_b"]
        for some in pairs.select(names).to_batches(max_chunksize=8192):
            for a, b, n_a, n_b in zip(*[c.to_pylist() for c in some.columns], strict=True):
                x, y = found.get(a, none), found.get(b, none)
                elsewhere = min(n_a - len(x), n_b - len(y))
                cuts = x[:: 1 + len(x) // 16]
                if elsewhere + suffix_bound(x, y, cuts) < least_overlap(n_a, n_b, percent):
                    continue
                both = len(np.intersect1d(x, y, assume_unique=True))
                if both:
                    counted.append((a, b, n_a, n_b, both))
        return pa.table({c: pa.array([k[i] for k in counted], pa.int64()) for i, c in enumerate([*names, "n_both"])})

    keys = ["place", "block", "part"]
    counts = sets.groupBy(*keys).cogroup(keyed.groupBy(*keys)).applyInArrow(
        compared, "a long, b long, n_a long, n_b long, n_both long"
    )
    whole = counts.groupBy("a", "b", "n_a", "n_b").agg(F.sum("n_both").alias("n_both"))
    return whole.filter(100 * F.col("n_both") >= percent * (F.col("n_a") + F.col("n_b") - F.col("n_both"))).select("a", "b")


def _blocks(pairs: DataFrame, of_vertex: DataFrame) -> DataFrame:
    """``(a, b, n_a, n_b, component, blocks, block)``: a component's pairs in blocks of bounded size.

    A block has all pairs of its vertices b, as many as their grams allow.  A
    vertex b of more pairs than a block may have is cut again, by a.
    """
    of_a = of_vertex.select(F.col("vertex").alias("a"), F.col("n").alias("n_a"), "component")
    of_b = of_vertex.select(F.col("vertex").alias("b"), F.col("n").alias("n_b"))
    sized = materialize(pairs.join(of_a, "a").join(of_b, "b"), "sized-pairs")
    in_blocks = lambda column, most=_PAIRS_IN_A_PLACE: F.ceil(F.col(column) / F.lit(most)).cast("long")
    blocks = sized.groupBy("component").agg(F.count(F.lit(1)).alias("pairs"))
    blocks = blocks.join(of_vertex.groupBy("component").agg(F.sum("n").alias("grams")), "component")
    count = F.greatest(in_blocks("pairs"), in_blocks("grams", _GRAMS_IN_A_PLACE))
    blocks = materialize(blocks.select("component", count.alias("blocks")), "blocks")
    # One row for every so many pairs at most.
    heavy = sized.groupBy("b").agg(F.count(F.lit(1)).alias("pairs")).filter(F.col("pairs") > _PAIRS_IN_A_PLACE)
    heavy = materialize(heavy.select("b", in_blocks("pairs").alias("cuts")), "heavy")
    cut = F.pmod(F.xxhash64("a"), F.coalesce("cuts", F.lit(1)))
    block = F.pmod(F.xxhash64("b", cut), F.col("blocks"))
    return sized.join(F.broadcast(heavy), "b", "left").join(blocks, "component").withColumn("block", block).drop("cuts")


def _places(pairs: DataFrame, vertices: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(doc_id, body, vertex, places)`` and ``(place, block, part, a, b, n_a, n_b)``.

    ``places`` are the structs (place, block, ranges) a set is needed in.  A
    block of a component with more grams than fit one place has a place of its
    own for each of several ranges of hashes; small components share places.
    """
    component = connected_components(pairs).withColumnRenamed("node", "vertex")
    of_vertex = materialize(vertices.select("vertex", "doc_id", "body", "n").join(component, "vertex"), "involved")
    blocked = materialize(_blocks(pairs, of_vertex), "blocked-pairs")
    cut = blocked.filter("blocks > 1")
    needs = [cut.select("component", "block", F.col(v).alias("vertex"), F.col(f"n_{v}").alias("n")) for v in "ab"]
    uncut = of_vertex.join(cut.select("component").distinct(), "component", "left_anti")
    needed = needs[0].unionByName(needs[1]).distinct()
    needed = materialize(needed.unionByName(uncut.select("component", F.lit(0).cast("long").alias("block"), "vertex", "n")), "needed")
    sizes = needed.groupBy("component", "block").agg(F.sum("n").alias("grams"))
    counts = blocked.groupBy("component", "block").agg(F.count(F.lit(1)).alias("pairs"), F.max("blocks").alias("blocks"))
    sizes = sizes.join(counts, ["component", "block"])
    sizes = materialize(sizes.withColumn("ranges", F.ceil(F.col("grams") / F.lit(_GRAMS_IN_A_PLACE)).cast("long")), "sizes")
    grams, n_pairs = sizes.filter("blocks = 1").agg(F.sum("grams"), F.sum("pairs")).first()
    shared = max(1, (grams or 0) // _GRAMS_SHARING, (n_pairs or 0) // _PAIRS_IN_A_PLACE)
    # Shared places have numbers from 0, so those of large components are negative.
    place = F.when((F.col("ranges") == 1) & (F.col("blocks") == 1), F.pmod("component", F.lit(shared))).otherwise(
        -1 - F.col("component").bitwiseAND(F.lit((1 << 62) - 1))
    )
    sizes = materialize(sizes.select("component", "block", "ranges", place.alias("place")), "block-places")
    of_set = needed.join(sizes, ["component", "block"]).groupBy("vertex").agg(
        F.collect_list(F.struct("place", "block", "ranges")).alias("places")
    )
    of_set = materialize(of_vertex.select("doc_id", "body", "vertex").join(of_set, "vertex"), "in-places")
    keyed = blocked.join(sizes, ["component", "block"]).select(
        "place", "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("ranges") - 1)).alias("part"), "a", "b", "n_a", "n_b"
    )
    return of_set, materialize(keyed, "keyed-pairs")


def met_pairs(rows: DataFrame, known: DataFrame, percent: int, other_components: bool) -> DataFrame:
    """Distinct pairs ``(a, b)`` of vertices that share a gram of ``rows(gram, vertex, n, pos, met)`` and may link.

    ``met`` is how many rows the gram has.  Rows of a gram meet in blocks of
    bounded size: both sides are cut by their vertices, and each block of one
    side goes to every block of the other.  With ``other_components`` only
    pairs between components of ``known(vertex, component, s0..s7)`` are met.
    """
    # A pair is met at the first gram it shares, as far as four earlier ones tell.
    earlier = Window.partitionBy("vertex").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("earlier", F.array_compact(F.array(*[F.nth_value("gram", i).over(earlier) for i in range(1, 5)])))
    rows = rows.join(known.select("vertex", "component", *_SKETCH), "vertex")
    rows = rows.withColumn("cuts", F.ceil(F.col("met") / F.lit(_ROWS_THAT_MEET)).cast("long"))
    rows = materialize(rows.withColumn("own", F.pmod(F.xxhash64("vertex"), F.col("cuts"))).drop("met"), "open-prefixes")
    sides = ["vertex", "n", "pos", "component", "earlier", *_SKETCH]
    # Both sides of a gram of one block are the same rows, which are shuffled once.
    whole = rows.filter("cuts = 1").select("gram", *sides)
    ends = [F.col(f"l.{c}") for c in sides] + [F.col(f"r.{c}").alias(f"{c}_b") for c in sides]
    whole = whole.alias("l").join(whole.alias("r"), F.col("l.gram") == F.col("r.gram")).select(*ends)
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("cuts") - 1))
    cut = rows.filter("cuts > 1")
    left = cut.select("gram", F.col("own").alias("i"), every.alias("j"), *sides)
    right = cut.select("gram", every.alias("i"), F.col("own").alias("j"), *[F.col(c).alias(f"{c}_b") for c in sides])
    met = whole.unionByName(left.join(right, ["gram", "i", "j"]).drop("gram", "i", "j"))
    met = met.filter(F.col("vertex") < F.col("vertex_b"))
    if other_components:
        met = met.filter(F.col("component") != F.col("component_b"))
    return _pairs(met.filter(_may_link(percent) & _sketches_may_link(percent) & ~F.arrays_overlap("earlier", "earlier_b")))


def _shared_prefixes(docs: DataFrame, words: int, percent: int, kept: ExitStack) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Members and vertices of ``docs``, and the prefix rows of grams that several vertices have, which end with ``kept``."""
    members, frequencies = document_sets(docs, words)
    vertices = members.filter("n_shingles > 0").groupBy("vertex").agg(
        F.min(F.struct(F.coalesce("doc_id", F.lit(_NO_ID)).alias("doc_id"), "body")).alias("first"),
        F.max("n_shingles").alias("n"),
        *[F.max(s).alias(s) for s in [*_SKETCH, "parity"]],
    )
    vertices = materialize(vertices.select("*", "first.*").drop("first"), "vertices")
    # A gram of one vertex pairs nothing: most rows end here, within one shuffle.
    shared = with_hub(prefixes(docs, words, percent, frequencies), "gram", "part")
    shared = kept.enter_context(materialized(shared, "prefixes"))
    return members, vertices, shared


def ngram_jaccard_join(docs: DataFrame, *, words: int = 5, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """Documents by set, and all links between sets.

    Returns ``members(doc_id, n_shingles, vertex, ...)``, one row per row of
    ``docs``, and ``links(a, b)``: every pair a < b of vertices whose word n-gram
    sets have a Jaccard similarity of ``percent`` or more.  Documents of equal
    sets have one vertex, so their pairs are in ``members``.  A group of k
    distinct near copies has up to k(k-1)/2 links, and all are compared; where
    only the groups count, ``connecting_links`` has fewer.  A null text, or one
    without words, has an empty set (n_shingles 0) and no link.  Columns other
    than doc_id and text are ignored.
    """
    with ExitStack() as kept:
        members, vertices, shared = _shared_prefixes(docs, words, percent, kept)
        met = materialize(shared.groupBy("gram").agg(F.count(F.lit(1)).alias("met")).filter("met > 1"), "shared-grams")
        rows = shared.select("gram", "vertex", "n", "pos").join(met, "gram")
        known = vertices.select("vertex", F.col("vertex").alias("component"), *_SKETCH)
        pairs = met_pairs(rows, known, percent, other_components=False)
        pairs = materialize(long_sketches_may_link(pairs, vertices, percent), "all-pairs")
    return members, materialize(verified(docs, pairs, vertices, words, percent), "all-links")


def link_counts(docs: DataFrame, *, words: int = 5, percent: int = 80) -> DataFrame:
    """``(doc_id, n_shingles, n_links)``, one row per row of ``docs``.

    ``n_links`` counts the other rows whose sets are as similar as ``percent``,
    equal ones included; that of an empty set is 0.
    """
    members, links = ngram_jaccard_join(docs, words=words, percent=percent)
    copies = members.filter("n_shingles > 0").groupBy("vertex").agg(F.count(F.lit(1)).alias("copies"))
    copies = materialize(copies, "set-sizes")
    ends = links.select(F.col("a").alias("vertex"), F.col("b").alias("other")).unionByName(
        links.select(F.col("b").alias("vertex"), F.col("a").alias("other"))
    )
    of_other = copies.select(F.col("vertex").alias("other"), F.col("copies").alias("rows"))
    others = materialize(ends.join(of_other, "other").groupBy("vertex").agg(F.sum("rows").alias("others")), "link-counts")
    counts = copies.join(others, "vertex", "left").select(
        "vertex", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")
    )
    counted = members.select("doc_id", "n_shingles", "vertex").join(materialize(counts, "counts"), "vertex", "left")
    n_links = F.when(F.col("n_shingles") > 0, F.col("n_links")).otherwise(F.lit(0).cast("long"))
    return counted.select("doc_id", "n_shingles", n_links.alias("n_links"))


def _still_open(
    vertices: DataFrame, shared: DataFrame, links: DataFrame, kept: ExitStack
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Vertices and prefix rows with the component ``links`` give them, and grams of several components.

    They are written tables that end with ``kept``.
    """
    component = materialize(connected_components(links), "components")
    known = vertices.select("vertex", *_SKETCH).join(component.withColumnRenamed("node", "vertex"), "vertex", "left")
    known = kept.enter_context(materialized(known.withColumn("component", F.coalesce("component", "vertex")), "known"))
    placed = shared.select("gram", "vertex", "n", "pos").join(known.select("vertex", "component"), "vertex")
    placed = kept.enter_context(materialized(placed, "placed-prefixes"))
    spread = placed.groupBy("gram").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("met"))
    spread = spread.filter(F.col("low") < F.col("high")).select("gram", "met")
    return known, placed, kept.enter_context(materialized(spread, "open-grams"))


def connecting_links(docs: DataFrame, *, words: int = 5, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """As ``ngram_jaccard_join``, with links that connect all that is linked.

    Every link between different sets is in ``links`` or lies within a
    component that ``links`` connects: pairs whose ends are already connected
    through a hub or neighbours are not compared.
    """
    with ExitStack() as kept, ExitStack() as round_:
        members, vertices, shared = _shared_prefixes(docs, words, percent, kept)
        of_a = vertices.select(F.col("vertex").alias("a"), "n", *_SKETCH)
        of_b = vertices.select(F.col("vertex").alias("b"), F.col("n").alias("n_b"), *[F.col(s).alias(f"{s}_b") for s in _SKETCH])

        def written(pairs: DataFrame, label: str) -> DataFrame:
            likely = pairs.join(of_a, "a").join(of_b, "b").filter(_sketches_may_link(percent)).select("a", "b")
            return materialize(long_sketches_may_link(likely, vertices, percent), label)

        tied = materialize(hub_candidates(shared, percent), "hub-pairs")
        links = materialize(verified(docs, written(tied, "likely"), vertices, words, percent), "hub-links")

        # What is left: vertices of one gram in different components.  Neighbours in
        # it come first where many would meet: they connect most large families.
        known, placed, open_grams = _still_open(vertices, shared, links, round_)
        if (open_grams.agg(F.sum(F.col("met") * F.col("met"))).first()[0] or 0) > 2 * _PAIRS_MET_AT_ONCE:
            near = neighbour_candidates(placed.join(open_grams, "gram"), percent).join(tied, ["a", "b"], "left_anti")
            near = written(near, "neighbours")
            tied = tied.unionByName(near)
            if not near.isEmpty():
                links = materialize(links.unionByName(verified(docs, near, vertices, words, percent)), "links-so-far")
                round_.close()
                known, placed, open_grams = _still_open(vertices, shared, links, round_)
        rest = met_pairs(placed.drop("component").join(open_grams, "gram"), known, percent, other_components=True)
        rest = long_sketches_may_link(rest.join(tied, ["a", "b"], "left_anti"), vertices, percent)
        rest = materialize(rest, "other-pairs")
    if rest.isEmpty():
        return members, links
    return members, materialize(links.unionByName(verified(docs, rest, vertices, words, percent)), "links")


def near_duplicate_groups(docs: DataFrame, *, words: int = 5, percent: int = 80) -> DataFrame:
    """``(doc_id, n_shingles, component_id)``, one row per row of ``docs``.

    ``component_id`` is the smallest doc_id that links reach; documents with
    equal, non-empty sets are linked.  A document with an empty set is its own
    component.
    """
    members, links = connecting_links(docs, words=words, percent=percent)
    members = members.select("doc_id", "n_shingles", "vertex")
    component = connected_components(links)
    placed = members.join(component.withColumnRenamed("node", "vertex"), "vertex", "left").withColumn(
        "component", F.when(F.col("n_shingles") > 0, F.coalesce("component", "vertex"))
    )
    placed = materialize(placed, "placed")
    least = placed.filter("n_shingles > 0").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    least = materialize(least, "least")
    return placed.join(least, "component", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def one_of_each_group(docs: DataFrame, *, words: int = 5, percent: int = 80) -> DataFrame:
    """The document with the smallest doc_id of each group of near duplicates.

    Documents without words are no copies of each other and stay, as do rows
    with a null doc_id; rows of one doc_id share its fate.
    """
    groups = near_duplicate_groups(docs, words=words, percent=percent)
    dropped = materialize(groups.filter("doc_id > component_id").select("doc_id").distinct(), "copies")
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)
