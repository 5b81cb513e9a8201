"""A corpus pipeline: language, near duplicates, source mix, sampled pieces."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from velotide.llm import language, mixing, ngram_join, sentence_pieces
from velotide.llm.common import octets, table
from velotide.llm.queries import PIECES
from velotide.sources.scratch import materialize


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; ``und`` and doubtful ones go."""
    return language.confident(docs, language.fit(docs))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of every group linked by five-word shingles at 0.8."""
    return ngram_join.one_of_each_group(docs, words=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the weighted mix takes them: never, once or twice."""
    return mixing.mixed_documents(docs)


def sample_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document and whether they decode to its text."""
    model = public_tokenizers.path(PIECES)
    cut = docs.withColumn("cut", sentence_pieces.round_trip("doc_id", octets("text"), model))
    return cut.select("doc_id", "source", "lang", "cut.piece_ids", "cut.lossless")


STAGES = [
    ("language_id", keep_known_languages),
    ("ngram_jaccard_join", keep_one_of_near_copies),
    ("mix_sources", mix_sources),
    ("sentence_pieces", sample_pieces),
]

# The model's scores and the draws of pieces have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
