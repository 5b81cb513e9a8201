"""The n-gram join on long sets, which short sketches cannot tell apart, and on large groups."""

from __future__ import annotations

from pathlib import Path

import numpy as np
from pyspark.sql import functions as F

from test_corpus_operators import table
from velotide.llm import components, ngram_join


def test_long_sets_without_a_link_are_not_gathered(spark):
    """Candidates of a shared gram grow with its square; sets are only read again where they may link."""
    draw = np.random.default_rng(3)
    texts = [[f"w{x}" for x in draw.integers(0, 1 << 30, 3000)] for _ in range(12)]
    texts[-1] = [*texts[-2][:2990], *texts[-1][2990:]]
    texts += [["short", f"text{i}"] for i in range(2)]
    docs = table(spark, [(i, " ".join(words)) for i, words in enumerate(texts)])
    members, _ = ngram_join.document_sets(docs, 4)
    vertices = members.withColumnRenamed("n_shingles", "n")
    vertex = {r["doc_id"]: r["vertex"] for r in vertices.collect()}
    every = [tuple(sorted((vertex[i], vertex[k]))) for i in range(14) for k in range(i) if (i < 12) == (k < 12)]
    pairs = spark.createDataFrame(every, "a long, b long")
    left = {(r["a"], r["b"]) for r in ngram_join.long_sketches_may_link(pairs, vertices, 85).collect()}
    assert left == {tuple(sorted((vertex[i], vertex[i + 1]))) for i in (10, 12)}


def test_long_sketches_never_exceed_the_difference():
    draw = np.random.default_rng(5)
    assert ngram_join.long_parity(np.arange(512, dtype=np.uint64)) is None
    for n_a, n_b, shared in [(600, 600, 599), (1000, 1100, 900), (1000, 1030, 1000), (3000, 2500, 0), (520, 5000, 300)]:
        grams = draw.permutation(np.unique(draw.integers(0, 1 << 63, n_a + n_b - shared, dtype=np.uint64)))
        a, b = np.sort(grams[:n_a]), np.sort(grams[n_a - shared :])
        differ = ngram_join.parity_difference(ngram_join.long_parity(a), ngram_join.long_parity(b))
        assert differ <= n_a + n_b - 2 * shared and differ % 2 == (n_a + n_b) % 2
        if shared == 0:
            assert differ > n_a + n_b - 2 * ngram_join.least_overlap(n_a, n_b, 80)


def test_pairs_of_a_large_component_are_not_repeated_for_every_range(spark, monkeypatch):
    """Ten times the grams that fit one place are ten blocks, not all pairs in each of ten ranges."""
    monkeypatch.setattr(ngram_join, "_GRAMS_IN_A_PLACE", 1000)
    pairs = spark.createDataFrame([(0, i) for i in range(1, 100)], "a long, b long")
    vertices = spark.createDataFrame([(i, i, i, 100) for i in range(100)], "vertex long, doc_id long, body long, n long")
    _, keyed = ngram_join._places(pairs, vertices)
    assert keyed.select("a", "b").distinct().count() == 99
    assert keyed.count() <= 3 * 99


def test_rows_that_meet_are_shuffled_once(spark):
    known = spark.range(20).select(F.col("id").alias("vertex"), F.col("id").alias("component"))
    known = known.withColumns({s: F.lit(0).cast("long") for s in ngram_join._SKETCH})
    rows = spark.range(20).select(
        (F.col("id") % 5).alias("gram"), F.col("id").alias("vertex"), F.lit(30).alias("n"), F.lit(0).alias("pos"), F.lit(4).cast("long").alias("met")
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        met = ngram_join.met_pairs(rows, known, 85, other_components=True)
        assert {(r["a"], r["b"]) for r in met.collect()} == {(a, b) for b in range(20) for a in range(b) if a % 5 == b % 5}
        assert "ReusedExchange" in met._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_components_of_one_task_are_those_of_stars(spark, monkeypatch):
    draw = np.random.default_rng(9)
    edges = [tuple(map(int, e)) for e in draw.integers(-400, 400, (300, 2))] + [(i, i + 1) for i in range(1000, 1200)]
    edges = spark.createDataFrame([*edges, (7, 7), (None, 3)], "a long, b long")
    by_task = sorted(map(tuple, components.connected_components(edges).collect()))
    monkeypatch.setattr(components, "_EDGES_OF_A_TASK", 0)
    assert by_task == sorted(map(tuple, components.connected_components(edges).collect()))
    assert dict(by_task)[1200] == 1000


def test_tables_of_finished_rounds_are_deleted(spark):
    """What the pipeline's second stage leaves on disk has a row a document, none for every gram."""
    folder = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:")) / "velotide"
    before = set(folder.glob("*"))
    words = [f"word{i}" for i in range(60)]
    docs = table(spark, [(i, " ".join([*words, f"end{i}"])) for i in range(6)] + [(9, "another text without copies at all")])
    assert sorted(r["doc_id"] for r in ngram_join.one_of_each_group(docs, words=5, percent=80).collect()) == [0, 9]
    left = {p.name.rsplit("-", 1)[0] for p in set(folder.glob("*")) - before}
    assert "vertices" in left and not left & {"prefixes", "placed-prefixes", "open-grams", "known"}
