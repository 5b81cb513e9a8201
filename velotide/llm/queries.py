"""The registered queries of the corpus operators."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velotide.llm import (
    embedding_join,
    fingerprints,
    language,
    lexical_search,
    mixing,
    ngram_join,
    one_bit_search,
    resharding,
    sentence_pieces,
    spelling,
    url_templates,
    warc,
    wavelet,
)
from velotide.llm.common import octets, table
from velotide.llm.oracles import ORACLES

PIECES = "piece_bpe_32k.model"
TOKENIZER = "byte_bpe_50k.json"

URL_RULES = [
    url_templates.Rule("net", "/", "block"),
    url_templates.Rule("example.net", "/en/", "allow"),
    url_templates.Rule("example.com", "/de/", "block"),
    url_templates.Rule("org", "/fr/", "allow"),
]


def op1_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprints.fingerprints(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprints.printed(F.col("sketch")).alias("fingerprint"),
        fingerprints.printed(F.col("edited_sketch")).alias("edited_fingerprint"),
        fingerprints.containment(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        fingerprints.containment(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicate_groups(table(spark, sf_dir, "documents"), words=4, percent=85)


def op3_pivot_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_join.near_vectors(table(spark, sf_dir, "embeddings"), cosine=0.9)


def op4_warc_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages"))


def op5_min_cost_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = resharding.reshard(table(spark, sf_dir, "documents"), old_shards=6, new_shards=8)
    return moved.select(
        "doc_id",
        "size",
        F.crc32(octets("text")).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.tokenised(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    model = language.fit(docs.filter(~held_out))
    found = language.identify(docs.drop("lang"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op8_path_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    bad = labels.select(F.col("doc_id").alias("page_id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int").alias("bad"))
    return url_templates.judged(table(spark, sf_dir, "pages"), bad, URL_RULES)


def op9_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path(PIECES)
    trip = sentence_pieces.round_trip("doc_id", octets("text"), model)
    cut = table(spark, sf_dir, "documents").select("doc_id", trip.alias("d"))
    return cut.select("doc_id", "d.piece_ids", "d.n_pieces", "d.ids_crc32", "d.lossless")


def op10_weighted_fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(mixing.mix(table(spark, sf_dir, "documents")))


def op11_stratified_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = lexical_search.build_index(table(spark, sf_dir, "documents"))
    return lexical_search.search(index, table(spark, sf_dir, "benchmark"), k=20)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(spelling.word_counts(table(spark, sf_dir, "documents")))


def op13_one_bit_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return one_bit_search.nearest(vectors, vectors.filter(F.col("vec_id") % 20 == 0), k=20)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
