"""A family of texts near the threshold is connected before all its pairs are met."""

import random

from pyspark.sql import functions as F

from velotide.llm import ngram_join


def test_neighbours_connect_a_family_before_its_pairs_are_met(spark, monkeypatch):
    draw = random.Random(5)
    base = [f"w{i}" for i in range(400)]
    texts = []
    for i in range(60):
        words = list(base)
        # Four inner words and the last: 17 of 397 grams differ, so most pairs are just below 0.85.
        for at in [*draw.sample(range(8, 390), 4), 399]:
            words[at] = f"x{i}y{at}"
        texts.append(" ".join(words))
    sets = [{tuple(w[k : k + 4]) for k in range(len(w) - 3)} for w in map(str.split, texts)]
    component = list(range(60))
    for a in range(60):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]) and component[a] != component[b]:
                low, high = sorted((component[a], component[b]))
                component = [low if c == high else c for c in component]

    met, plain = [], ngram_join.met_pairs

    def counted(*args, **settings):
        pairs = plain(*args, **settings)
        met.append(pairs.count())
        return pairs

    monkeypatch.setattr(ngram_join, "met_pairs", counted)
    monkeypatch.setattr(ngram_join, "_PAIRS_MET_AT_ONCE", 100, raising=False)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows = ngram_join.near_duplicate_groups(docs, words=4, percent=85).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == dict(enumerate(component))
    assert sum(met) <= 60


def test_neighbours_are_fewer_than_rows(spark):
    rows = spark.range(300).select(
        F.lit(7).cast("long").alias("gram"),
        F.col("id").alias("vertex"),
        F.lit(50).alias("n"),
        F.lit(0).alias("pos"),
        (F.col("id") % 100).alias("component"),
        F.lit(300).cast("long").alias("met"),
    )
    pairs = ngram_join.neighbour_candidates(rows, 85).collect()
    assert 250 < len(pairs) < 300
    assert all(r["a"] < r["b"] and r["a"] % 100 != r["b"] % 100 for r in pairs)
