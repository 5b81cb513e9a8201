import math
from collections import Counter

import numpy as np

from velotide.llm import embedding_join

SCHEMA = "vec_id long, embedding array<double>"


def _found(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted((tuple(r) for r in embedding_join.near_vectors(df, cosine=0.9).collect()), key=repr)


def test_rows_that_share_an_id_are_rows_of_their_own(spark):
    rows = [(5, [1.0, 0.0]), (5, [0.0, 1.0]), (7, [1.0, 0.01]), (8, [0.01, 1.0])]
    assert _found(spark, rows) == [(5, 1, 5, True), (5, 1, 5, True), (7, 1, 5, False), (8, 1, 5, False)]
    apart = [(5, [1.0, 0.0]), (5, [0.0, 1.0]), (4, [1.0, 0.01]), (8, [0.01, 1.0])]
    assert _found(spark, apart) == [(4, 1, 4, True), (5, 1, 4, False), (5, 1, 5, True), (8, 1, 5, False)]


def test_repeated_rows_link_with_each_other(spark):
    assert _found(spark, [(3, [1.0, 2.0])] * 3) == [(3, 2, 3, True)] * 3


def test_vectors_of_different_lengths_never_link(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0, 0.0]), (3, [1.0, 0.05]), (4, [1.0, 0.05, 0.0]), (5, [1.0]), (6, [1.0] * 6)]
    assert _found(spark, rows) == [
        (1, 1, 1, True), (2, 1, 2, True), (3, 1, 1, False), (4, 1, 2, False), (5, 0, 5, True), (6, 0, 6, True)]


def test_null_ids_and_unusable_vectors_take_no_part(spark):
    rows = [(None, [1.0, 0.0]), (1, [1.0, 0.0]), (2, None), (2, [0.0, 0.0]), (3, [math.inf, 1.0]), (4, [-0.0, 1.0]), (5, [0.0, 1.0])]
    assert _found(spark, rows) == sorted(
        [(None, 0, None, True), (1, 0, 1, True), (2, 0, 2, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False)], key=repr)


def test_runs_follow_the_guests_of_a_cell(spark, monkeypatch):
    monkeypatch.setattr(embedding_join, "CELL_VECTORS", 30)
    monkeypatch.setattr(embedding_join, "BLOCK_VECTORS", 10)
    monkeypatch.setattr(embedding_join, "GUESTS_IN_A_RUN", 20)
    pick = np.random.default_rng(9)
    centres = np.eye(6)
    rows = [(i % 150, (centres[i % 6] + pick.normal(size=6) * 0.15).tolist()) for i in range(180)]
    unit = np.array([v for _, v in rows])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    label = np.array([i for i, _ in rows])
    while True:
        lower = np.array([label[n].min() for n in near])
        if (lower == label).all():
            break
        label = lower
    want = Counter((i, int(n.sum()) - 1, int(c), bool(i == c)) for (i, _), n, c in zip(rows, near, label, strict=True))
    assert Counter(_found(spark, rows)) == want


def test_of_two_blocks_one_visits_the_other():
    blocks = np.array([1, 3, 0, 2, 1])
    numbers = [(cell, block) for cell, n in enumerate(blocks) for block in range(n)]
    home, turn = (np.array(x) for x in zip(*numbers, strict=True))
    # Pivots as far from each other as from the vectors: neither bound rules out a cell.
    near, gaps, radius = np.zeros((len(home), len(blocks))), np.ones((len(blocks),) * 2), np.full(len(blocks), 2.0)
    who, cell, block = embedding_join._visits(near, turn, home, gaps, blocks, radius, 0.5)
    visits = [(numbers[w], (c, b)) for w, c, b in zip(who.tolist(), cell.tolist(), block.tolist(), strict=True)]
    assert Counter(map(frozenset, visits)) == Counter(frozenset((a, b)) for a in numbers for b in numbers if a < b)
    assert set(Counter(b for _, b in visits).values()) == {3}


def test_odd_components_and_repeated_vectors(spark):
    rows = [
        (1, [1.0, 0.0]), (2, [1.0, -0.0]), (2, [1.0, 0.0]), (3, []), (4, [None, 1.0]), (5, [math.nan, 1.0]),
        (6, None), (None, None), (7, [1e300, 1e299]), (8, [0.0, -0.0]), (9, [1.0]), (10, [2.0])]
    assert _found(spark, rows) == sorted(
        [(1, 3, 1, True), (2, 3, 1, False), (2, 3, 1, False), (7, 3, 1, False), (9, 1, 9, True), (10, 1, 9, False)]
        + [(i, 0, i, True) for i in (3, 4, 5, 6, 8, None)], key=repr)
