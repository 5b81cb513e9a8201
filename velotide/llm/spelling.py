"""Spelling variants: near words found by exact signatures of their letters.

Words one edit apart have letter multisets that, as binary vectors over
(letter, occurrence), differ in two places at most: in two if a letter is
replaced, in one if it is inserted or deleted.  The letters are partitioned; a
vector's signatures are what is left of it without every choice of as many
partitions as places may differ.  Two vectors within that distance share at
least one signature, so an equi-join finds all of them, and the words behind
them are verified by their edit distance.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velotide.llm.common import octets, rows_of
from velotide.sources.scratch import materialize

# UTF-8 of runs of A-Z, a-z and U+00C0 to U+00FF.
_RUN = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\xbf])+")
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")

# Every so many (document, run) lose a letter.
EDITED = 97
PARTITIONS = 8
# Distinct words a task counts before it passes the counts on.
_HELD = 1 << 17


def edited_run(doc_id: str, run: bytes) -> bytes:
    """The run without one code point if the checksum of document and run says so."""
    h = zlib.crc32(b"%s:%s" % (doc_id.encode(), run))
    if h % EDITED:
        return run
    letters = run.decode()
    place = h % len(letters)
    return (letters[:place] + letters[place + 1 :]).encode()


def word_counts(docs: DataFrame, *, id_column: str = "doc_id", text: str = "text", edit: bool = True) -> DataFrame:
    """``word, n``: occurrences of the lower-cased runs of all whole texts.

    A null text has no runs, a null id counts as an empty one.  With ``edit``
    the runs of a document pass ``edited_run``; empty results are left out.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def flushed() -> pa.RecordBatch:
            words = pa.array(list(counts), pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(list(counts.values()), pa.int64())], ["word", "n"])

        for ids, bodies in rows_of(batches, "id", "body"):
            for doc_id, body in zip(ids, bodies, strict=True):
                for run, times in Counter(_RUN.findall(body.translate(_LOWER))).items():
                    word = edited_run(doc_id, run) if edit else run
                    if word:
                        counts[word] += times
                if len(counts) >= _HELD:
                    yield flushed()
                    counts.clear()
        if counts:
            yield flushed()

    slim = docs.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("id"), octets(text).alias("body"))
    return slim.mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def letters_of(word: str) -> Column:
    """The letter multiset of a word: its letters in order."""
    return F.array_join(F.array_sort(F.filter(F.split(word, ""), lambda c: c != "")), "")


def letter_partitions(vectors: DataFrame, partitions: int) -> list[str]:
    """Letters dealt to partitions in turn, back and forth, by falling frequency.

    One row a letter reaches the driver: the alphabet, whatever the number of words.
    """
    counts = vectors.select(F.explode(F.split("letters", "")).alias("letter")).filter("letter <> ''").groupBy("letter").count()
    ranked = [r["letter"] for r in sorted(counts.collect(), key=lambda r: (-r["count"], r["letter"]))]
    dealt = [""] * partitions
    for i, letter in enumerate(ranked):
        turn, place = divmod(i, partitions)
        dealt[place if turn % 2 == 0 else partitions - 1 - place] += letter
    return dealt


def _signatures(parts: list[str], distance: int) -> Column:
    """What is left of a vector without each choice of ``distance`` partitions."""
    choices = []
    for number, chosen in enumerate(combinations(parts, distance)):
        left_out = "".join(chosen)
        rest = F.translate("letters", left_out, "") if left_out else F.col("letters")
        choices.append(F.struct(F.lit(number).alias("choice"), rest.alias("rest")))
    return F.explode(F.array(*choices))


def near_vectors(vectors: DataFrame, partitions: int = PARTITIONS) -> DataFrame:
    """``letters, letters_b``: pairs of different multisets that may hold words one edit apart, once each.

    Of one length they differ in two places; else the second is longer by one
    letter and they differ in one place.
    """
    parts = letter_partitions(vectors, partitions)
    sized = vectors.select("letters", F.length("letters").alias("size"))
    two = sized.withColumn("s", _signatures(parts, 2)).select("letters", "size", "s.choice", "s.rest")
    two = materialize(two, "two-away")
    same = two.alias("a").join(two.alias("b"), ["size", "choice", "rest"]).filter(
        (F.col("a.letters") < F.col("b.letters")) & (F.levenshtein("a.letters", "b.letters", 2) >= 0)
    )
    one = sized.withColumn("s", _signatures(parts, 1)).select("letters", "size", "s.choice", "s.rest")
    one = materialize(one, "one-away")
    longer = one.withColumn("size", F.col("size") - 1)
    other = one.alias("a").join(longer.alias("b"), ["size", "choice", "rest"]).filter(
        F.levenshtein("a.letters", "b.letters", 1) >= 0
    )
    pair = [F.col("a.letters").alias("letters"), F.col("b.letters").alias("letters_b")]
    return same.select(*pair).unionByName(other.select(*pair)).distinct()


def near_words(words: DataFrame, partitions: int = PARTITIONS) -> DataFrame:
    """``a, b``: all pairs of ``words(word, ...)`` one insertion, deletion or replacement apart, once each."""
    lettered = materialize(words.select("word", letters_of("word").alias("letters")), "lettered")
    pairs = materialize(near_vectors(lettered.select("letters").distinct(), partitions), "vectors")
    first = pairs.join(lettered.withColumnRenamed("word", "a"), "letters").select("a", F.col("letters_b").alias("letters"))
    second = lettered.withColumnRenamed("word", "b")
    return first.join(second, "letters").filter(F.levenshtein("a", "b", 1) == 1).select("a", "b")


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for every word that has a form: the end of its chain of forms.

    Each round doubles the steps taken.  n at least doubles with every step, so
    chains are short and have no circles.
    """
    ahead = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = ahead.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = materialize(ahead.join(step, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        ahead = moved.drop("moved")
        if moved.filter("moved").isEmpty():
            return ahead


def spelling_variants(
    counts: DataFrame, *, least_length: int = 5, least_n: int = 3, times: int = 2, partitions: int = PARTITIONS
) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` for every frequent word of ``counts(word, n)``.

    ``n_near`` counts the words one edit away, ``form`` is the one of largest n
    (ties: the smallest in code point order) if that is at least ``times`` n,
    and ``root`` the last word when forms are followed, the word itself if it has
    none.  Without words the result is empty.
    """
    frequent = (F.length("word") >= least_length) & (F.col("n") >= least_n)
    words = materialize(counts.filter(frequent).select("word", "n"), "words")
    pairs = materialize(near_words(words, partitions), "near")
    either = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    of_near = words.select(F.col("word").alias("b"), F.col("n").alias("n_b"))
    best = either.join(of_near, "b").groupBy(F.col("a").alias("word")).agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n_b")).alias("n"), F.col("b").alias("word"))).alias("best")
    )
    enough = -F.col("best.n") >= times * F.col("n")
    known = words.join(best, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("best.word")).alias("form"),
        F.when(enough, -F.col("best.n")).alias("form_n"),
    )
    known = materialize(known, "forms")
    found = roots(known.filter("form IS NOT NULL"))
    return known.join(found, "word", "left").withColumn("root", F.coalesce("root", "word"))
