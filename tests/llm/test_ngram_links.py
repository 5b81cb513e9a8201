"""All links of the n-gram join, and how many each document has."""

from __future__ import annotations

from collections import Counter

from test_corpus_operators import prose, table, varied
from velotide.llm import ngram_join


def brute_links(rows, words, percent):
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[k : k + words]) for k in range(max(1, len(w) - words + 1))} if w else set())
    return [
        (x, y)
        for y in range(len(sets))
        for x in range(y)
        if 100 * len(sets[x] & sets[y]) >= percent * len(sets[x] | sets[y]) and sets[x]
    ]


def test_links_within_groups_are_all_there(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "_ROWS_THAT_MEET", 10)
    monkeypatch.setattr(ngram_join, "_PAIRS_IN_A_PLACE", 150)
    copies = prose(5, 120)
    rows = [(i, varied(copies, i, 1)) for i in range(30)] + [(40 + i, prose(90 + i, 80)) for i in range(5)]
    rows += [(50, rows[0][1]), (51, rows[0][1].upper()), (None, rows[3][1]), (60, None), (61, " "), (62, "one"), (63, "ONE")]
    want = brute_links(rows, 4, 80)
    assert len(want) > 200  # a tree over the group would have about 30
    counts = Counter(i for pair in want for i in pair)
    found = ngram_join.link_counts(table(spark, rows), words=4, percent=80).collect()
    assert Counter((r["doc_id"], r["n_links"]) for r in found) == Counter((i, counts[k]) for k, (i, _) in enumerate(rows))

    members, links = ngram_join.ngram_jaccard_join(table(spark, rows), words=4, percent=80)
    vertex = {r["doc_id"]: r["vertex"] for r in members.collect()}
    of_row = [vertex[i] for i, _ in rows]
    pairs = {tuple(sorted((of_row[x], of_row[y]))) for x, y in want if of_row[x] != of_row[y]}
    assert sorted((r["a"], r["b"]) for r in links.collect()) == sorted(pairs)
