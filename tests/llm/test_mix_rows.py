"""The mix on rows that are repeated exactly and on rows without doc_id."""

from __future__ import annotations

from collections import Counter

from test_corpus_operators import table
from velotide.llm import mixing


def test_every_row_keeps_its_own_taken_count(spark):
    rows = [(1, "a b c", None, "s")] * 4 + [(None, "d e f", None, "s")] * 3 + [(None, "g h i", None, "t")] * 3
    rows += [(10 + i, "k l m", None, "t") for i in range(10)]
    found = mixing.taken_words(mixing.mix(table(spark, rows))).collect()
    assert len(found) == len(rows)
    assert all(r["taken"] in (0, r["size"], 2 * r["size"]) for r in found)
    assert sum(r["taken"] for r in found) <= 1.5 * 3 * len(rows)


def test_mixed_rows_keep_to_the_budget(spark):
    rows = [(1, "a b c", None, "s")] * 7 + [(None, f"d e f{i}", None, "s") for i in range(5)]
    rows += [(None, "g h i", None, "t")] * 9 + [(None, None, None, "t")]
    docs = table(spark, rows)
    taken = Counter()
    for r in mixing.taken_words(mixing.mix(docs)).collect():
        taken[r["doc_id"], r["source"]] += r["taken"]
    out = mixing.mixed_documents(docs).collect()
    got = Counter()
    for r in out:
        got[r["doc_id"], r["source"]] += len((r["text"] or "").split())
    assert +got == +taken and sum(got.values()) <= 1.5 * 3 * 21
    again = mixing.mixed_documents(table(spark, rows[::-1]).repartition(4)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, out))
