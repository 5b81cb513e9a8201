"""The n-gram join on groups that are too large for one task."""

from __future__ import annotations

from pyspark.sql import functions as F

from test_corpus_operators import brute_groups, prose, table, varied
from velotide.llm import ngram_join


def test_pairs_of_a_group_are_compared_in_blocks(spark, monkeypatch):
    """No task gets all pairs of a component, nor all pairs of a vertex or a gram."""
    copies = prose(71, 150)
    rows = [(9000 + i, varied(copies, i, 2)) for i in range(60)]
    monkeypatch.setattr(ngram_join, "_PAIRS_IN_A_PLACE", 40)
    monkeypatch.setattr(ngram_join, "_ROWS_THAT_MEET", 20)
    monkeypatch.setattr(ngram_join, "_SENT_BYTES", 1000)
    most, places = [], ngram_join._places

    def counted(pairs, vertices):
        of_set, keyed = places(pairs, vertices)
        sizes = keyed.filter("place < 0").groupBy("place", "block", "part").count()
        most.append((pairs.count(), sizes.agg(F.max("count")).first()[0] or 0))
        return of_set, keyed

    monkeypatch.setattr(ngram_join, "_places", counted)
    found = ngram_join.near_duplicate_groups(table(spark, rows), words=4, percent=85).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute_groups(rows, 4, 85)
    assert max(pairs for pairs, _ in most) > 60 and all(size <= 70 for _, size in most)


def test_pairs_of_one_vertex_are_cut(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "_PAIRS_IN_A_PLACE", 10)
    pairs = spark.createDataFrame([(i, 1000) for i in range(200)], "a long, b long")
    vertices = spark.createDataFrame([(i, i, i, 7) for i in [*range(200), 1000]], "vertex long, doc_id long, body long, n long")
    of_set, keyed = ngram_join._places(pairs, vertices)
    assert keyed.count() == 200
    assert keyed.groupBy("place", "block", "part").count().agg(F.max("count")).first()[0] <= 60
    needed = {(r["vertex"], p["place"], p["block"]) for r in of_set.collect() for p in r["places"]}
    assert {(r[v], r["place"], r["block"]) for r in keyed.collect() for v in "ab"} == needed
