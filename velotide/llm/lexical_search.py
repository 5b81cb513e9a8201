"""Ranked lexical search over a length-stratified index.

Documents whose length gives the same normaliser m form a stratum; a large
stratum is cut into blocks.  Within a block the postings of a term are ordered
by tf, so an impact is computed once for each tf of a stratum.  The highest tf
of every term bounds what any document of a block can score: blocks are visited
in the order of that bound, and those that cannot reach an item's k-th best
score so far are not visited at all.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from velotide.llm.common import octets, rows_of, shuffle_partitions
from velotide.sources.scratch import materialize, materialize_in_buckets, materialized

# For every byte of UTF-8 what it is in a term: A-Z are lowered, digits, a-z and all but ASCII stay, others part terms.
_IN_TERMS = bytes(ord(chr(b).lower()) if b < 0x80 and chr(b).isalnum() else b if b >= 0x80 else 0x20 for b in range(256))

# Postings of a block aimed at; a block and the items that visit it are in one task.
BLOCK_POSTINGS = 1 << 16
# Items that visit a block together, on average.
ITEMS_AT_ONCE = 256
# Blocks of highest bound an item visits before the others are ruled out.
FIRST_BLOCKS = 4

# (term, tf) entries that leave a task as one batch.
_ENTRIES = 1 << 18
# Postings, or scores, of the items that are scored in a block at once.
_CELLS = 1 << 18
_BLOCK = pa.schema(
    [
        ("m", pa.int64()),
        ("chunk", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("terms", pa.string()),
        ("tops", pa.list_(pa.int32())),
        ("dfs", pa.list_(pa.int32())),
        ("starts", pa.binary()),
        ("places", pa.binary()),
        ("tfs", pa.binary()),
    ]
)


@dataclass(frozen=True)
class Index:
    """Written tables: ``blocks`` of postings, ``terms(term, df)``, and the totals N and L."""

    blocks: DataFrame
    terms: DataFrame
    documents: int
    occurrences: int


def term_counts(rows: DataFrame, key: str, text: str) -> DataFrame:
    """``key, salt, n, entries, terms, tfs``: the terms of every whole text with their occurrences.

    Terms are runs of digits, letters a-z and characters beyond ASCII; only A-Z
    are lowered.  A null text has none.  ``terms`` has the ``entries`` different
    ones with a space between.  ``salt`` numbers the rows of a task.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt, waiting, entries = 0, [], 0

        def flushed() -> pa.RecordBatch:
            keys, salts, sizes, found = zip(*waiting, strict=True)
            entries = np.array([len(f) for f in found], np.int32)
            offsets = np.concatenate(([0], np.cumsum(entries))).astype(np.int32)
            terms = pa.array([b" ".join(f) for f in found], pa.binary()).cast(pa.string())
            tfs = np.fromiter(chain.from_iterable(f.values() for f in found), np.int32, offsets[-1])
            counts = [pa.array(keys, key_type), pa.array(salts, pa.int64()), pa.array(sizes, pa.int64()), pa.array(entries)]
            names = ["key", "salt", "n", "entries", "terms", "tfs"]
            return pa.RecordBatch.from_arrays([*counts, terms, pa.ListArray.from_arrays(offsets, tfs)], names)

        for batch in batches:
            key_type = batch.schema.field("key").type
            for keys, bodies in rows_of([batch], "key", "body"):
                for k, body in zip(keys, bodies, strict=True):
                    occurring = body.translate(_IN_TERMS).split()
                    found = Counter(occurring)
                    waiting.append((k, salt, len(occurring), found))
                    salt, entries = salt + 1, entries + len(found)
                    if entries >= _ENTRIES:
                        yield flushed()
                        waiting, entries = [], 0
        if waiting:
            yield flushed()

    slim = rows.select(F.col(key).alias("key"), octets(text).alias("body"))
    kind = slim.schema["key"].dataType.simpleString()
    return slim.mapInArrow(counted, f"key {kind}, salt long, n long, entries int, terms string, tfs array<int>")


def normaliser(n: str, documents: int, occurrences: int) -> Column:
    """m of a document of ``n`` terms: 75 and 25 times its length by the mean length, in whole numbers."""
    return F.expr(f"75L + (25L * {n} * {documents}L) div {max(1, occurrences)}L")


def build_index(docs: DataFrame, *, id_column: str = "doc_id", text: str = "text", block_postings: int = BLOCK_POSTINGS) -> Index:
    """Index every row of ``docs``; other columns are ignored.

    Each row is a document of its own, also if ids repeat or are null.
    """
    ids = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))
    counted = term_counts(ids, "doc_id", "text").withColumnRenamed("key", "doc_id").filter("n > 0")
    # The counts by document are done with once they are inverted.
    with materialized(counted, "forward") as forward:
        return _index_of(forward, block_postings)


def _index_of(forward: DataFrame, block_postings: int) -> Index:
    total = forward.agg(F.count(F.lit(1)).alias("N"), F.coalesce(F.sum("n"), F.lit(0)).alias("L")).first()
    placed = forward.withColumn("m", normaliser("n", total["N"], total["L"]))
    strata = materialize(
        placed.groupBy("m").agg(F.ceil(F.sum("entries") / F.lit(block_postings)).cast("long").alias("chunks")), "strata"
    )
    dealt = placed.join(strata, "m").select("m", F.pmod("salt", "chunks").alias("chunk"), "doc_id", "terms", "tfs")
    buckets = shuffle_partitions(forward.sparkSession)
    dealt = dealt.repartition(buckets, "m", "chunk").sortWithinPartitions("m", "chunk", F.asc_nulls_last("doc_id"))
    schema = "m long, chunk long, doc_ids array<long>, terms string, tops array<int>, dfs array<int>, starts binary, places binary, tfs binary"
    # In buckets, so that blocks stay where they are when items visit them.
    blocks = materialize_in_buckets(dealt.mapInArrow(_inverted, schema), "blocks", buckets, "m", "chunk")
    # Blocks have a term once, with the number of its documents there.
    terms = materialize(_by_term(blocks, "dfs").groupBy("term").agg(F.sum("dfs").alias("df")), "terms")
    return Index(blocks, terms, total["N"], total["L"])


def _by_term(blocks: DataFrame, counts: str) -> DataFrame:
    """``m, chunk, term`` and the number that the list ``counts`` has for the term, a row a term of a block."""
    spread = blocks.select("m", "chunk", counts, F.posexplode(F.split("terms", " ")).alias("place", "term"))
    return spread.select("m", "chunk", "term", F.get(counts, F.col("place")).alias(counts))


def _inverted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a block from rows sorted by block and document."""
    key, parts = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(i).to_numpy() for i in range(2)], axis=1)
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
        for first, last in zip(cuts, cuts[1:], strict=False):
            place = tuple(keys[first].tolist())
            if place != key and parts:
                yield _block(key, parts)
                parts = []
            key = place
            parts.append(batch.slice(first, last - first))
    if parts:
        yield _block(key, parts)


def _place_type(documents: int) -> type:
    return np.uint16 if documents <= 1 << 16 else np.int32


def _one_list(values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _block(key: tuple[int, int], parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    rows = pa.Table.from_batches(parts).combine_chunks()
    lists = pc.split_pattern(rows.column("terms").combine_chunks(), " ")
    doc = np.repeat(np.arange(len(rows), dtype=np.int32), pc.list_value_length(lists).to_numpy())
    coded = pc.list_flatten(lists).dictionary_encode()
    code = coded.indices.to_numpy().astype(np.int64)
    tf = pc.list_flatten(rows.column("tfs").combine_chunks()).to_numpy().astype(np.int64)
    # By term, then falling tf; a stable order leaves documents in theirs.
    order = np.argsort(code * (tf.max() + 1) - tf, kind="stable")
    dfs = np.bincount(code, minlength=len(coded.dictionary))
    starts = np.concatenate(([0], np.cumsum(dfs)))
    tf = tf[order]
    ids = rows.column("doc_id").combine_chunks()
    return pa.RecordBatch.from_arrays(
        [
            pa.array([key[0]]),
            pa.array([key[1]]),
            _one_list(ids),
            pc.binary_join(_one_list(coded.dictionary), " "),
            _one_list(pa.array(tf[starts[:-1]], pa.int32())),
            _one_list(pa.array(dfs, pa.int32())),
            pa.array([starts.astype(np.int32).tobytes()], pa.binary()),
            pa.array([doc[order].astype(_place_type(len(rows))).tobytes()], pa.binary()),
            pa.array([tf.astype(np.int32).tobytes()], pa.binary()),
        ],
        schema=_BLOCK,
    )


def _weighed(items: DataFrame, index: Index) -> DataFrame:
    """``item, term, weight``: weights of the terms of each item that occur in the index, repeats summed."""
    asked = term_counts(items, "item", "text").filter("n > 0").withColumn("terms", F.split("terms", " "))
    asked = asked.select("key", F.explode(F.arrays_zip("terms", "tfs")).alias("t"))
    asked = asked.select(F.col("key").alias("item"), F.col("t.terms").alias("term"), F.col("t.tfs").alias("times"))
    rarity = F.floor(F.lit(1000) * F.log(F.lit(2.0 * index.documents + 2) / (F.lit(2) * F.col("df") + 1)))
    known = materialize(asked, "asked").join(index.terms, "term")
    return known.select("item", "term", (F.col("times") * rarity.cast("long")).alias("weight"))


def _bounds(index: Index, weighed: DataFrame) -> DataFrame:
    """``item, m, chunk, bound``: no document of the block scores more for the item."""
    met = _by_term(index.blocks, "tops").join(weighed, "term")
    impact = F.expr("(1000000000L * tops) div (1000L * tops + 12L * m)")
    return met.groupBy("item", "m", "chunk").agg(F.sum(F.col("weight") * impact).alias("bound")).filter("bound > 0")


def _visited(index: Index, visits: DataFrame, payload: DataFrame, batches: int, k: int) -> DataFrame:
    """``item, doc_id, score``: the k best of each block for the items ``visits(item, m, chunk, least)`` sends there."""
    asking = visits.join(payload, "item").groupBy(
        "m", "chunk", F.pmod(F.xxhash64("item"), F.lit(batches)).alias("together")
    )
    asking = asking.agg(F.collect_list(F.struct("item", "least", "terms", "weights")).alias("queries"))
    rows = index.blocks.drop("tops", "dfs").join(asking.hint("shuffle_hash"), ["m", "chunk"]).drop("chunk", "together")

    def scored(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for i in range(batch.num_rows):
                yield from _scores(batch.slice(i, 1), k)

    return rows.mapInArrow(scored, "item string, doc_id long, score long")


def _scores(row: pa.RecordBatch, k: int) -> Iterator[pa.RecordBatch]:
    """Scores of one block for the items that visit it."""
    m = row.column("m")[0].as_py()
    ids = row.column("doc_ids").flatten()
    kept_as = {"starts": np.int32, "places": _place_type(len(ids)), "tfs": np.int32}
    starts, places, tfs = (np.frombuffer(row.column(c)[0].as_buffer(), kind) for c, kind in kept_as.items())
    kinds, which = np.unique(tfs, return_inverse=True)
    kinds = kinds.astype(np.int64)
    impacts = ((1_000_000_000 * kinds) // (1000 * kinds + 12 * m))[which]
    queries = row.column("queries").flatten()
    names, least, terms, weights = (queries.field(i) for i in range(4))
    terms = pc.split_pattern(terms, " ")
    at = pc.fill_null(pc.index_in(terms.flatten(), value_set=pc.split_pattern(row.column("terms"), " ").flatten()), -1).to_numpy()
    query = np.repeat(np.arange(len(names)), pc.list_value_length(terms).to_numpy())
    here = at >= 0
    at, query, weight = at[here], query[here], weights.flatten().to_numpy()[here]
    sizes = starts[at + 1] - starts[at]
    load = np.cumsum(np.maximum(np.bincount(query, sizes, len(names)), len(ids))) // _CELLS
    cuts = [0, *(np.flatnonzero(load[1:] != load[:-1]) + 1).tolist(), len(names)]
    floors = np.maximum(least.to_numpy(), 1)
    kept: list[tuple[np.ndarray, ...]] = []
    for first, last in zip(cuts, cuts[1:], strict=False):
        part = slice(*np.searchsorted(query, (first, last)))
        size = sizes[part]
        posting = np.arange(size.sum()) + np.repeat(starts[at[part]] - np.cumsum(size) + size, size)
        total = np.zeros((last - first, len(ids)), np.int64)
        item = np.repeat(query[part] - first, size)
        np.add.at(total.ravel(), item * len(ids) + places[posting], np.repeat(weight[part], size) * impacts[posting])
        floor = floors[first:last]
        if k < len(ids):
            floor = np.maximum(floor, np.partition(total, -k, axis=1)[:, -k])
        item, hit = np.nonzero(total >= floor[:, None])
        # Documents are in the order of their ids, which settles ties.
        order = np.lexsort((hit, -total[item, hit], item))
        item, hit = item[order], hit[order]
        best = np.arange(len(item)) - np.searchsorted(item, item) < k
        kept.append((first + item[best], hit[best], total[item[best], hit[best]]))
    of_item, hits, scores = (np.concatenate(x) for x in zip(*kept, strict=True))
    if len(hits):
        yield pa.RecordBatch.from_arrays([names.take(pa.array(of_item)), ids.take(pa.array(hits)), pa.array(scores)], ["item", "doc_id", "score"])


def search(
    index: Index,
    items: DataFrame,
    *,
    k: int = 20,
    id_column: str = "item_id",
    text: str = "text",
    first_blocks: int = FIRST_BLOCKS,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of every item, best first.

    Only scores above 0 count; equal scores are ranked by ascending doc_id, null
    last.  Rows of ``items`` with the same id and text are one item, rows with
    one id and different texts are ranked apart.  Items without a text or a known
    term have no rows, as have all items over an empty index.
    """
    name = F.concat_ws("/", F.coalesce(F.col(id_column).cast("string"), F.lit("")), F.md5(octets(text)))
    asked = materialize(items.select(name.alias("item"), F.col(id_column).alias("item_id"), F.col(text).alias("text")).distinct(), "items")
    weighed = materialize(_weighed(asked, index), "weighed")
    payload = weighed.groupBy("item").agg(
        F.concat_ws(" ", F.collect_list("term")).alias("terms"), F.collect_list("weight").alias("weights")
    )
    batches = max(1, -(-asked.count() // ITEMS_AT_ONCE))
    by_bound = Window.partitionBy("item").orderBy(F.desc("bound"), "m", "chunk")
    bounds = materialize(_bounds(index, weighed), "bounds")
    leading = bounds.withColumn("place", F.row_number().over(by_bound)).filter(F.col("place") <= first_blocks)
    leading = materialize(leading.select("item", "m", "chunk", F.lit(0).cast("long").alias("least")), "leading")
    by_score = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = materialize(_visited(index, leading, payload, batches, k), "best")
    # The k-th best score so far: later documents must reach it.
    ranked = best.withColumn("place", F.row_number().over(by_score)).filter(F.col("place") == k)
    least = ranked.select("item", F.col("score").alias("least"))
    rest = bounds.join(leading.drop("least"), ["item", "m", "chunk"], "left_anti").join(least, "item", "left")
    rest = rest.withColumn("least", F.coalesce("least", F.lit(0))).filter("bound >= least").drop("bound")
    more = materialize(_visited(index, rest, payload, batches, k), "more")
    ranked = best.unionByName(more).withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= k)
    return ranked.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
