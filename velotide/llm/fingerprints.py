"""Threshold-scaled sketches: every shingle hash below a fixed fraction of the range.

DataFrame operations only.  Sketches of parts merge by union, and the share of
one sketch found in another estimates how much of a text another contains,
however different their lengths.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from velotide.llm.common import SPACES, shuffle_partitions
from velotide.sources.scratch import materialize

# Hashes are 63-bit; one in SCALE is kept.
SCALE = 8
SHINGLE_WORDS = 5

# Neighbours are found within ranges of doc_id: so many for each shuffle partition.
_RANGES_A_PARTITION = 4


def sketch(text: Column, *, words: int = SHINGLE_WORDS, scale: int = SCALE) -> Column:
    """Sorted distinct hashes below 2**63 / scale of the text's word shingles.

    Words are runs of anything but space and tab to return, lower-cased.  A text
    with fewer words has one shingle of all of them.  When no hash is below the
    bound the smallest is kept, so only a null text or one without words has an
    empty sketch.
    """
    hashed = F.transform(
        F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), SPACES), lambda w: w != ""),
        lambda w: F.xxhash64(w),
    )

    def shingles(h: Column) -> Column:
        # One pass per place would copy the array; each shingle reads its words by index.
        whole = F.transform(
            F.sequence(F.lit(1), F.size(h) - F.lit(words - 1)),
            lambda i: F.shiftrightunsigned(F.xxhash64(*[F.get(h, i - 1 + k) for k in range(words)]), 1),
        )
        short = F.array(F.shiftrightunsigned(F.xxhash64(h, F.size(h)), 1))
        return F.when(F.size(h) >= words, whole).when(F.size(h) > 0, short).otherwise(F.array().cast("array<bigint>"))

    def kept(all_hashes: Column) -> Column:
        low = F.array_sort(F.array_distinct(F.filter(all_hashes, lambda x: x < (1 << 63) // scale)))
        least = F.array_min(all_hashes)
        return F.when(F.size(low) > 0, low).when(least.isNull(), F.array().cast("array<bigint>")).otherwise(F.array(least))

    return _let(hashed, lambda h: _let(shingles(h), kept))


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def printed(sketch_column: Column) -> Column:
    """A sketch as text, 16 hexadecimal digits a hash in ascending order."""
    return F.lower(F.array_join(F.transform(sketch_column, lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def containment(a: Column, b: Column) -> Column:
    """Share of the smaller sketch that the other has; 1 for two empty ones, 0 for one."""
    smaller = F.least(F.size(a), F.size(b))
    return (
        F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0)
        .when(smaller == 0, 0.0)
        .otherwise(F.size(F.array_intersect(a, b)) / smaller)
    )


def merged(a: Column, b: Column) -> Column:
    """Sketch of two texts together, but for shingles across their border."""
    return F.array_sort(F.array_union(a, b))


def with_next(docs: DataFrame) -> DataFrame:
    """``doc_id, text, next_text``: the next document in descending doc_id, after the last the first.

    One shuffle of the texts: documents go to ranges of doc_id whose borders are
    approximate quantiles, and the first of each range goes to the one before it
    as well.  Null ids come last; rows of one doc_id are in the order of their
    text's hash.  A single document is its own next.
    """
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    ids = rows.select("doc_id")
    ranges = _RANGES_A_PARTITION * shuffle_partitions(docs.sparkSession)
    shares = [i / ranges for i in range(1, ranges)]
    borders = ids.agg(F.percentile_approx("doc_id", shares, 20 * ranges).alias("b")).first()["b"] or []
    borders = sorted(set(borders))
    dealt = rows.withColumn("range", _range_of(F.col("doc_id"), borders))
    by_range = Window.orderBy("range")
    heads = (
        ids.withColumn("range", _range_of(F.col("doc_id"), borders))
        .groupBy("range")
        .agg(F.max("doc_id").alias("head"))
        .withColumn("before", F.lag("range").over(by_range))
        .withColumn("before", F.coalesce("before", F.max("range").over(Window.partitionBy())))
    )
    heads = materialize(heads, "heads")  # a row a range
    both = dealt.join(F.broadcast(heads), "range").withColumn(
        "place",
        F.explode(
            F.when(
                F.col("doc_id").eqNullSafe(F.col("head")),
                F.array(F.struct("range", F.lit(False).alias("guest")), F.struct(F.col("before").alias("range"), F.lit(True).alias("guest"))),
            ).otherwise(F.array(F.struct("range", F.lit(False).alias("guest"))))
        ),
    )
    placed = both.select("doc_id", "text", "place.range", "place.guest").repartition(shuffle_partitions(docs.sparkSession), "range")
    order = Window.partitionBy("range").orderBy("guest", F.desc_nulls_last("doc_id"), F.xxhash64("text"))
    following = placed.withColumn("next_text", F.lead("text").over(order))
    return following.filter(~F.col("guest")).select("doc_id", "text", "next_text")


def _range_of(value: Column, borders: list) -> Column:
    """Number of the descending range a value is in, by binary search; null is the last."""
    if not borders:
        return F.when(value.isNull(), 1).otherwise(0)
    steps = [1 << i for i in reversed(range(len(borders).bit_length()))]
    table = F.array(*map(F.lit, borders))
    below = F.aggregate(
        F.array(*map(F.lit, steps)),
        F.lit(0),
        lambda at, step: F.when(
            (at + step <= len(borders)) & (F.get(table, F.least(at + step, F.lit(len(borders))) - 1) <= value), at + step
        ).otherwise(at),
    )
    return F.when(value.isNull(), len(borders) + 1).otherwise(len(borders) - below)


def edited(text: Column, following: Column) -> Column:
    """The last third of a text (rounded down, in code points) replaced by as many first of another."""
    third = F.floor(F.length(text) / F.lit(3)).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - third), F.substring(following, F.lit(1), third))


def fingerprints(docs: DataFrame, *, words: int = SHINGLE_WORDS, scale: int = SCALE) -> DataFrame:
    """``doc_id, text, edited, next_text`` with ``sketch``, ``edited_sketch`` and ``next_sketch``.

    One row per row of ``docs``; a null text counts as empty.  Columns other
    than doc_id and text are ignored.
    """
    rows = with_next(docs).withColumn("edited", edited(F.col("text"), F.col("next_text")))
    return rows.select(
        "*",
        *[
            sketch(F.col(c), words=words, scale=scale).alias(name)
            for c, name in (("text", "sketch"), ("edited", "edited_sketch"), ("next_text", "next_sketch"))
        ],
    )
