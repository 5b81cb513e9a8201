"""One-bit codes against exact products with all vectors."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from velotide.llm.one_bit_search import encode, estimate, nearest, rotation

ROWS = "vec_id long, embedding array<float>, label int, score string, rank string"


def plain(rows, wanted, k):
    """(query_id, rank, vec_id, score) by summing products in order."""

    def usable(i, v):
        return i is not None and v and None not in v and all(map(math.isfinite, v)) and any(v)

    kept = [(i, v) for i, v in rows if usable(i, v)]
    found = []
    for i, q in kept:
        if not wanted(i):
            continue
        scored = []
        for j, v in kept:
            if j != i and len(v) == len(q):
                total = 0.0
                for a, b in zip(q, v, strict=True):
                    total += a * b
                scored.append((-total, j))
        found += [(i, rank, j, -s) for rank, (s, j) in enumerate(sorted(scored)[:k], 1)]
    return sorted(found)


def ours(spark, rows, k, wanted=lambda c: c % 20 == 0, **settings):
    table = spark.createDataFrame([(i, v, 1, "x", "y") for i, v in rows], ROWS)
    found = nearest(table, table.filter(wanted(F.col("vec_id"))), k=k, **settings)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(tuple(r) for r in found.collect())


def floats(x):
    return [[float(np.float32(c)) for c in v] for v in x]


def test_recall_and_exact_scores(spark):
    generator = np.random.default_rng(13)
    centres = generator.standard_normal((30, 64))
    x = centres[generator.integers(0, 30, 3000)] + generator.standard_normal((3000, 64)) * 0.7
    x[::7] = generator.standard_normal((len(x[::7]), 64)) * 3
    rows = list(enumerate(floats(x)))
    got, want = ours(spark, rows, 20, block_vectors=256), plain(rows, lambda i: i % 20 == 0, 20)
    pairs = {(r[0], r[2]): r[3] for r in want}
    hits = [r for r in got if (r[0], r[2]) in pairs]
    assert len(hits) >= 0.999 * len(want)
    assert all(pairs[r[0], r[2]] == r[3] for r in hits)


def test_bounds_hold_for_nearly_all(spark):
    generator = np.random.default_rng(5)
    x, q = generator.standard_normal((2000, 64)) + 2, generator.standard_normal((50, 64)) + 2
    middle, doubt = estimate(q, *encode(x))
    assert np.mean(np.abs(middle - q @ x.T) <= doubt) > 0.9999
    # Half the exact products' spread at least is explained by the codes.
    assert np.std(middle - q @ x.T) < 0.5 * np.std(q @ x.T)
    assert np.allclose(rotation(64) @ rotation(64).T, np.eye(64))


def test_unusable_rows_ties_repeats_and_lengths(spark):
    rows = [(i, [1.0, 2.0]) for i in range(40)]
    rows += [(40, None), (60, [0.0, 0.0]), (80, [1.0, None]), (100, [float("nan"), 1.0]), (None, [5.0, 5.0]), (120, [])]
    rows += [(140, [3.0, 4.0, 5.0]), (141, [1.0, 0.0, 0.0]), (160, [-1.0, 0.0]), (161, [2.0])]
    got = ours(spark, rows, 5, block_vectors=16)
    assert got == plain(rows, lambda i: i % 20 == 0, 5)
    assert [r[2] for r in got if r[0] == 20] == [0, 1, 2, 3, 4]
    # Each of two rows with one id is a query of its own; neither finds the other.
    twice = ours(spark, [(20, [1.0, 0.0]), (20, [0.0, 1.0]), (1, [1.0, 3.0])], 5)
    assert twice == [(20, 1, 1, 1.0), (20, 1, 1, 3.0)]


def test_small_groups_of_queries_and_empty_tables(spark):
    generator = np.random.default_rng(7)
    rows = list(enumerate(floats(generator.standard_normal((200, 8)))))
    assert ours(spark, rows, 3, query_bytes=3 * 64, block_vectors=50) == plain(rows, lambda i: i % 20 == 0, 3)
    assert ours(spark, [], 3) == [] == ours(spark, [(1, [1.0])], 3) == ours(spark, [(20, [1.0])], 3)
