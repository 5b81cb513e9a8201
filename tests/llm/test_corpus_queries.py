"""The registered corpus queries and the pipeline on the smallest tables."""

from __future__ import annotations

import zlib

import duckdb
import pytest

import corpus_pipeline
from registry.check import connect, difference
from velotide.llm.queries import oracle_sql, queries

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_its_sql(spark, name):
    ours = queries()[name](spark, SMALL).toPandas()
    assert difference(ours, connect(SMALL).execute(oracle_sql()[name]).df()) is None


def documents():
    return duckdb.execute(f"SELECT doc_id, coalesce(text, ''), lang FROM read_parquet('{SMALL}/documents.parquet')").fetchall()


def test_sketch_query(spark):
    rows = {r["doc_id"]: r for r in queries()["op1_scaled_sketch"](spark, SMALL).collect()}
    docs = {i: t for i, t, _ in documents()}
    assert {i: r["n_chars"] for i, r in rows.items()} == {i: len(t) for i, t in docs.items()}
    long = [r for r in rows.values() if r["n_chars"] > 1000]
    assert sum(r["near_edited"] > r["near_next"] for r in long) >= 0.97 * len(long)
    assert all(0 <= r[c] <= 1 for r in rows.values() for c in ("near_edited", "near_next"))


def test_resharding_query(spark):
    rows = queries()["op5_min_cost_resharding"](spark, SMALL).collect()
    assert {r["doc_id"]: r["text_crc32"] for r in rows} == {i: zlib.crc32(t.encode()) for i, t, _ in documents()}
    assert {r["shard"] for r in rows} == set(range(8)) and {r["grown_shard"] for r in rows} == {None}


def test_language_query_on_documents_it_has_not_seen(spark):
    rows = {r["doc_id"]: r for r in queries()["op7_language_id"](spark, SMALL).collect()}
    held = [(i, lang) for i, _, lang in documents() if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(rows[i]["held_out"] for i, _ in held)
    assert sum(rows[i]["lang_pred"] == lang for i, lang in held) >= 0.97 * len(held)


def test_pieces_query(spark):
    rows = queries()["op9_sentence_pieces"](spark, SMALL).collect()
    assert len(rows) == len(documents()) and all(r["lossless"] for r in rows)


def test_tokens_query(spark):
    rows = sorted(queries()["op6_wavelet_tokens"](spark, SMALL).collect())
    assert [r["start"] for r in rows[1:]] == [r["start"] + r["n_tokens"] for r in rows[:-1]]


def test_templates_query(spark):
    rows = queries()["op8_path_templates"](spark, SMALL).collect()
    want = dict(duckdb.execute(f"SELECT page_id, lower(regexp_extract(url, '://([^/?#]*)', 1)) FROM read_parquet('{SMALL}/pages.parquet')").fetchall())
    assert {r["page_id"]: r["host"] for r in rows} == want
    assert {r["verdict"] for r in rows} == {"allow", "block"}


def test_pipeline_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        assert docs.columns == columns
    out = {(r["doc_id"], tuple(r["piece_ids"])) for r in corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()}
    again = corpus_pipeline.run(spark, SMALL).collect()
    assert {(r["doc_id"], tuple(r["piece_ids"])) for r in again} == out
    assert all(r["lossless"] for r in again)
