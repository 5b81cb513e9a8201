"""Ranked search against a plain ranking of every document for every item."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from velotide.llm import lexical_search
from velotide.llm.lexical_search import build_index, search

DOCS = "doc_id long, text string, m string, term string, rank int"
ITEMS = "item_id long, text string, doc_id string, score string"


def terms(text):
    lowered = re.sub("[A-Z]", lambda c: c.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def plain(docs, items, k):
    """(item_id, rank, doc_id, score) by scoring everything."""
    bags = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    big_n, big_l = len(bags), sum(b.total() for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    weight = {t: math.floor(1000 * math.log((2 * big_n + 2) / (2 * n + 1))) for t, n in df.items()}
    found = []
    for item, text in dict.fromkeys(items):
        scored = []
        for i, bag in bags:
            m = 75 + (25 * bag.total() * big_n) // big_l
            score = sum(weight[t] * (10**9 * bag[t] // (1000 * bag[t] + 12 * m)) for t in terms(text) if bag[t])
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        found += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scored)[:k], 1)]
    return sorted(found, key=repr)


def ours(spark, docs, items, k=20, **settings):
    table = spark.createDataFrame([(i, t, "x", "y", 1) for i, t in docs], DOCS)
    asked = spark.createDataFrame([(i, t, "x", "y") for i, t in items], ITEMS)
    first = {"first_blocks": settings.pop("first_blocks")} if "first_blocks" in settings else {}
    found = search(build_index(table, **settings), asked, k=k, **first)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in found.collect()), key=repr)


def prose(generator, n, words):
    return " ".join(generator.choice(words) for _ in range(n))


@pytest.mark.parametrize("first_blocks,block_postings", [(1, 40), (4, 1 << 16)])
def test_equals_the_plain_ranking(spark, first_blocks, block_postings):
    generator = random.Random(11)
    words = [f"w{int(generator.paretovariate(0.6))}" for _ in range(400)] + ["Straße", "ÉTÉ", "x9", "Öl-Preis"]
    docs = [(i, prose(generator, generator.choice([1, 3, 30, 30, 30, 200]), words)) for i in range(300)]
    items = [(i, prose(generator, 12, words)) for i in range(25)]
    assert ours(spark, docs, items, k=5, first_blocks=first_blocks, block_postings=block_postings) == plain(docs, items, 5)


def test_nulls_ties_repeats_and_long_texts(spark):
    docs = [(3, "a b"), (1, "a b"), (2, "a b"), (None, "a b"), (1, "a b"), (4, None), (5, ""), (6, "?!"), (7, "b " * 50_000 + "q")]
    docs += [(i, "c d") for i in range(10, 20)]
    items = [(1, "A a"), (1, "A a"), (2, None), (3, ""), (4, "zzz"), (None, "q"), (6, "b b b")]
    assert ours(spark, docs, items, k=4) == plain(docs, items, 4)
    # One id with two texts: each has ranks of its own.
    twice = ours(spark, docs, [(1, "a"), (1, "q")], k=4)
    assert sorted(r[1] for r in twice) == [1, 1, 2, 3, 4]


def test_empty_tables(spark):
    assert ours(spark, [], [(1, "a")]) == [] == ours(spark, [(1, "a")], []) == ours(spark, [(1, None)], [(1, "a")])


def test_a_stratum_of_many_equal_texts_is_cut(spark):
    docs = [(i, "same words in all of them") for i in range(500)] + [(1000, "same and other")]
    index = build_index(spark.createDataFrame(docs, "doc_id long, text string"), block_postings=200)
    sizes = [len(r["doc_ids"]) for r in index.blocks.select("doc_ids").collect()]
    assert sum(sizes) == 501 and max(sizes) < 150


def test_spaces_beyond_ascii_are_letters(spark):
    docs = [(1, "a\u00a0b c\x1cd\x85"), (2, "a\u2028b\x00c"), (None, "A\u00a0B"), (3, " "), (4, None)] + [(4, "c\tC\x0bd")] * 2
    items = [(1, "A\u00a0b"), (2, "c d"), (None, "a\u2028b c"), (3, None), (3, " \x1f"), (4, "c")]
    assert ours(spark, docs, items, k=3) == plain(docs, items, 3)


def test_terms_travel_as_text_and_are_counted_by_block(spark):
    docs = [(i, f"all some{i % 3} one{i} one{i}") for i in range(60)] + [(None, "all"), (7, None), (8, "..")]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    counted = lexical_search.term_counts(table, "doc_id", "text")
    assert dict(counted.dtypes)["terms"] == "string"
    rows = {(r["key"], r["n"]): (r["entries"], r["terms"].split(), r["tfs"]) for r in counted.collect()}
    assert rows[5, 4] == (3, ["all", "some2", "one5"], [1, 1, 2]) and rows[7, 0] == (0, [], []) == rows[8, 0]
    index = build_index(table, block_postings=20)
    assert index.blocks.count() > 5
    assert dict(index.blocks.dtypes)["terms"] == "string"
    df = Counter(t for _, text in docs for t in set(terms(text)))
    assert {r["term"]: r["df"] for r in index.terms.collect()} == df


@pytest.mark.parametrize("cells", [1, 100, 1 << 18])
def test_items_are_scored_some_at_a_time(monkeypatch, cells):
    monkeypatch.setattr(lexical_search, "_CELLS", cells)
    generator = random.Random(3)
    docs = [(i, Counter(generator.choices("abcdefgh", k=12))) for i in range(50)]
    columns = [[1] * 50, [0] * 50, [i for i, _ in docs], [" ".join(b) for _, b in docs]]
    tfs = pa.array([list(b.values()) for _, b in docs], pa.list_(pa.int32()))
    block = lexical_search._block((80, 0), [pa.RecordBatch.from_arrays([*map(pa.array, columns), tfs], ["m", "chunk", "doc_id", "terms", "tfs"])])
    asked = [("x", 0, "a b", [3, 5]), ("none", 0, "zz", [9]), ("y", 3000, "h zz a", [2, 7, 1]), ("z", 10**9, "c", [1])]
    queries = [dict(zip(("item", "least", "terms", "weights"), q, strict=True)) for q in asked]
    row = block.append_column("queries", pa.array([queries]))
    got = [tuple(r.values()) for batch in lexical_search._scores(row, 4) for r in batch.to_pylist()]
    want = []
    for item, least, words, weights in asked:
        scores = [(-sum(w * (10**9 * b[t] // (1000 * b[t] + 12 * 80)) for t, w in zip(words.split(), weights, strict=True)), i) for i, b in docs]
        want += [(item, i, -s) for s, i in sorted(scores)[:4] if -s >= max(least, 1)]
    assert got == want


def test_blocks_stay_in_their_buckets(spark):
    docs = [(i, f"all some{i % 3} one{i}") for i in range(60)]
    index = build_index(spark.createDataFrame(docs, "doc_id long, text string"), block_postings=20)
    asking = spark.createDataFrame([(75, 0, "x"), (75, 0, "y"), (9, 9, "z")], "m long, chunk long, item string")
    rows = index.blocks.join(asking.hint("shuffle_hash"), ["m", "chunk"])
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("blocks_")]
    # The name is gone, the files are read again and again.
    assert sum(len(r["doc_ids"]) for r in index.blocks.collect()) == sum(len(r["doc_ids"]) for r in index.blocks.collect()) == 60
