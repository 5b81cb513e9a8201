"""Mixing sources to target weights: weighted fair queueing, in DataFrame operations only.

Every document of a source gets a virtual finish time, the words of the source
up to and including it divided by the source's target.  Taken in order of that
time, sources advance together in proportion to their targets, and the mix may
end anywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from velotide.sources.scratch import materialize

# Finish times run from 0 to the number of passes; each unit is cut into so many
# bins, and the bin in which the budget ends once more.
_BINS = 2048

# Documents of one source ordered in one task, on average.
_ROWS_IN_A_RUN = 1024


def word_count(text: str) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+``, null as 0."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...], share_percent: int, passes: int) -> DataFrame:
    """``(source, source_size, weight, target)`` from ``sizes(source, source_size)``.

    Sources in code point order, null last, weigh ``weights`` in turn.  They
    share ``share_percent`` of all words by weight; a source's target stops at
    ``passes`` times its size and the excess goes to the others by weight, until
    none is above.  That ends at one water level for all sources that do not
    stop, which two windows over the sources find at once.  Sources that are one
    row each are few beside the documents.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    every = Window.partitionBy()
    fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("place"))
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    weighed = (
        sizes.withColumn("place", F.row_number().over(order))
        .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1))
        .withColumn("cap", F.col("source_size") * passes)
        .withColumn("budget", F.sum("source_size").over(every) * F.lit(share_percent) / F.lit(100.0))
        .withColumn("rank", F.row_number().over(fill))
        .withColumn("full_before", F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("weight_left", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    )
    # The level if this source and all later ones stay below their caps.
    level = (F.col("budget") - F.col("full_before")) / F.col("weight_left")
    holds = F.when(level * F.col("weight") <= F.col("cap"), level)
    return (
        weighed.withColumn("level", F.min_by(holds, F.when(holds.isNotNull(), F.col("rank"))).over(every))
        .withColumn(
            "target",
            F.when(F.col("level") * F.col("weight") < F.col("cap"), F.col("level") * F.col("weight")).otherwise(
                F.col("cap").cast("double")
            ),
        )
        .select("source", "source_size", "weight", "target")
    )


def shuffled(docs: DataFrame, seed: int) -> DataFrame:
    """``(doc_id, source, size, ticket, body, row)``: a reproducible order, independent of partitions.

    ``body`` is the text's hash, and ``row`` tells rows that are equal in all
    that apart; the table is written before it is read.
    """
    ticket = F.md5(F.concat(F.lit(f"{seed}/"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    return docs.select(
        "doc_id",
        "source",
        word_count("text").alias("size"),
        ticket.alias("ticket"),
        F.xxhash64("text").alias("body"),
        F.monotonically_increasing_id().alias("row"),
    )


def with_finish(order: DataFrame, plan: DataFrame, passes: int, rows: int) -> DataFrame:
    """Each document once per pass with its ``finish`` time.

    Running sums are taken in two steps, within runs of tickets and over the
    runs of a source, so that a source with most documents is no single task.
    Null sources are one source.
    """
    digits = max(1, min(8, -(-(max(rows // _ROWS_IN_A_RUN, 1)).bit_length() // 4)))
    cut = order.withColumn("run", F.substring("ticket", 1, digits)).withColumn("known", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
    in_run = Window.partitionBy("known", "run").orderBy("ticket", "doc_id", "size", "body", "row")
    runs = cut.groupBy("known", "run").agg(F.sum("size").alias("run_size"))
    earlier = Window.partitionBy("known").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("offset", F.coalesce(F.sum("run_size").over(earlier), F.lit(0))).drop("run_size")
    of_source = plan.withColumn("known", F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))).drop("source")
    starts = materialize(runs.join(of_source, "known"), "runs")
    summed = cut.withColumn("through", F.sum("size").over(in_run.rowsBetween(Window.unboundedPreceding, 0)))
    placed = summed.join(starts, ["known", "run"]).withColumn("through", F.col("through") + F.col("offset"))
    return (
        placed.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(passes - 1))))
        .withColumn("finish", (F.col("through") + F.col("copy") * F.col("source_size")) / F.when(F.col("target") > 0, F.col("target")))
        .select("doc_id", "source", "size", "source_size", "target", "ticket", "body", "row", "copy", "finish")
    )


def _bin(width: float) -> Column:
    return F.floor(F.col("finish") / F.lit(width)).cast("long")


def within_budget(copies: DataFrame, budget: float) -> DataFrame:
    """The copies, with ``in_mix``: first in the global order and ``budget`` words at most.

    The order is by finish time, then source, ticket and copy.  Finish times are
    cut into ranges; whole ranges before the one in which the budget ends are in,
    that range is cut again, and only the last piece is put in order row by row.
    """
    bins = 1.0 / _BINS
    edge, left = _edge(copies.filter(F.col("finish").isNotNull()).groupBy(_bin(bins).alias("bin")), budget)
    inside = copies.filter(_bin(bins) == edge)
    fine = bins / _BINS
    fine_edge, left = _edge(inside.groupBy(_bin(fine).alias("bin")), left)
    order = Window.partitionBy("one").orderBy("finish", F.col("source").isNull(), "source", "ticket", "copy", "doc_id", "size", "body", "row")
    running = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
    cut_in = F.coalesce((_bin(bins) == edge) & (_bin(fine) == fine_edge), F.lit(False))
    whole = F.coalesce((_bin(bins) < edge) | ((_bin(bins) == edge) & (_bin(fine) < fine_edge)), F.lit(False))
    last = copies.filter(cut_in).withColumn("one", F.lit(1)).withColumn("in_mix", running <= left).drop("one")
    return copies.filter(~cut_in).withColumn("in_mix", whole).unionByName(last)


def _edge(binned, budget: float) -> tuple[int, float]:
    """The bin in which ``budget`` ends and what is left of it there."""
    sizes = binned.agg(F.sum("size").alias("size"))
    running = F.sum("size").over(Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
    hit = (
        sizes.withColumn("running", running)
        .filter(F.col("running") > budget)
        .agg(F.min(F.struct("bin", (F.lit(budget) - F.col("running") + F.col("size")).alias("left"))).alias("hit"))
        .first()["hit"]
    )
    return (hit["bin"], float(hit["left"])) if hit else (1 << 60, 0.0)


def mix(
    docs: DataFrame, *, weights: tuple[int, ...] = (3, 1, 2), share_percent: int = 150, passes: int = 2, seed: int = 0
) -> DataFrame:
    """Every row once per pass: ``doc_id, source, size, source_size, target, body, row, copy, finish, in_mix``.

    ``share_percent`` of all words is the total budget; see ``targets`` for the
    sources' parts.  A document has ``passes`` copies, so none is taken more
    often; copies with ``in_mix`` are the mix, in order of ``finish``.  Documents
    of size 0 take nothing; a source without words has target 0 and null finish
    times.  Reruns and other partitionings give the same rows; rows of one
    doc_id are ordered by size and text, and each has its own copies, known by
    ``row``.  Null sources are one source, the last.  Columns other than doc_id,
    text and source are ignored.
    """
    order = materialize(shuffled(docs, seed), "tickets")
    totals = order.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    totals = materialize(totals, "sources")
    rows, size = totals.agg(F.sum("rows"), F.sum("source_size")).first()
    plan = targets(totals.drop("rows"), weights, share_percent, passes)
    copies = materialize(with_finish(order, plan, passes, rows or 0), "copies")
    return within_budget(copies, (size or 0) * share_percent / 100.0)


def taken_words(copies: DataFrame) -> DataFrame:
    """One row per row of the documents of ``mix``: the words the mix takes of it, repeats counted."""
    return copies.groupBy("row", "doc_id", "source", "size", "source_size", "target").agg(
        F.sum(F.when(F.col("in_mix"), F.col("size")).otherwise(0)).alias("taken")
    ).drop("row")


def mixed_documents(docs: DataFrame, *, passes: int = 2, **settings) -> DataFrame:
    """The documents as often as the mix takes them, with their own columns.

    Rows are found again by doc_id, source and text.  Where the mix takes some
    of several rows that are equal in these more often than others (a few at the
    ends of passes), a hash of all columns decides which.
    """
    key = ["doc_id", "source", "body"]
    of_row = mix(docs, passes=passes, **settings).groupBy("row", *key).agg(F.count_if("in_mix").alias("times"))
    least, most = F.min("times").alias("_least"), F.max("times").alias("_times")
    # How many of the rows are taken once or more, twice or more, and so on.
    often = F.array(*[F.count_if(F.col("times") >= t) for t in range(1, passes + 1)]).alias("_often")
    of_key = of_row.groupBy(*key).agg(least, most, often).filter("_times > 0")
    of_key = materialize(of_key.withColumnsRenamed({c: f"_{c}" for c in key}), "times")
    fits = F.xxhash64(docs["text"]) == F.col("_body")
    for c in ("doc_id", "source"):
        fits &= docs[c].eqNullSafe(F.col(f"_{c}"))
    repeated = docs.join(of_key.filter("_least = _times"), fits).select(*docs.columns, "_times")
    uneven = of_key.filter("_least < _times")
    if not uneven.isEmpty():
        hashed = [f.name for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
        within = Window.partitionBy("_doc_id", "_source", "_body").orderBy(F.xxhash64(*hashed))
        some = docs.join(F.broadcast(uneven), fits).withColumn("_nth", F.row_number().over(within))
        some = some.withColumn("_times", F.size(F.filter("_often", lambda n: n >= F.col("_nth"))).cast("long"))
        repeated = repeated.unionByName(some.filter("_times > 0").select(*docs.columns, "_times"))
    again = F.explode(F.sequence(F.lit(1).cast("long"), F.col("_times")))
    return repeated.withColumn("_again", again).select(*docs.columns)
