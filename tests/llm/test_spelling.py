"""Spelling variants against comparing all words with all."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from velotide.llm import spelling


def one_edit(a: str, b: str) -> bool:
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_counts(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda c: c.group().lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if run:
                counts[run] += 1
    return counts


def plain(counts):
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, n, len(near[w]), form[w], words.get(form[w]), root(w)) for w, n in words.items())


def variants(spark, counts, **settings):
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = spelling.spelling_variants(table, **settings).select("word", "n", "n_near", "form", "form_n", "root")
    return sorted(tuple(r) for r in found.collect())


def invented(generator, n):
    parts = ["on", "the", "er", "ein", "ß", "é", "ent", "io", "st", "a"]
    words = ["".join(generator.choices(parts, k=generator.randint(2, 4))) for _ in range(n)]
    for _ in range(n):
        w, i = generator.choice(words), generator.randint(0, 5)
        words.append(w[:i] + generator.choice(["", "n", "xé"]) + w[i + generator.randint(0, 1) :])
    return words


@pytest.mark.parametrize("partitions", [3, 8])
def test_equals_comparing_all_words(spark, partitions):
    generator = random.Random(12)
    counts = {w: int(generator.paretovariate(0.5)) for w in invented(generator, 500)}
    counts |= {"kette": 3, "ketten": 6, "kettes": 6, "kettens": 12, "kattens": 24, "tekte": 3, "abcde": 2, "abcdf": 9}
    assert variants(spark, counts, partitions=partitions) == plain(counts)


def test_counts_of_documents(spark):
    generator = random.Random(13)
    docs = [(i, " ".join(generator.choices(["Straßen", "été", "WÖRTER", "wOrts", "a", "x×y÷z", "Œuvre"], k=40))) for i in range(60)]
    docs += [(None, "Straßen été"), (5, None), (6, ""), (7, "12 -- 3"), (1, "wort " * 30_000), (1, "wort")]
    table = spark.createDataFrame([(i, t, "clash", 9) for i, t in docs], "doc_id long, text string, word string, n int")
    found = {r["word"]: r["n"] for r in spelling.word_counts(table).collect()}
    assert found == dict(plain_counts(docs))
    assert spelling.word_counts(table.limit(0)).collect() == []


def test_ties_go_to_the_smallest_and_chains_end(spark):
    counts = {"bbbbb": 3, "abbbb": 6, "cbbbb": 6, "abbb": 100, "abbbbb": 12, "abbbbbb": 24}
    assert variants(spark, counts) == plain(counts)
    by_word = {r[0]: r for r in variants(spark, counts)}
    assert by_word["bbbbb"][3:] == ("abbbbb", 12, "abbbbbb")
    assert by_word["cbbbb"][3] is None or by_word["cbbbb"][5] == by_word["cbbbb"][3]


def test_no_words(spark):
    empty = spark.createDataFrame([], "word string, n long")
    assert spelling.spelling_variants(empty).collect() == []
    alone = spark.createDataFrame([("lonely", 7), ("rare", 1)], "word string, n long")
    assert [tuple(r) for r in spelling.spelling_variants(alone).collect()] == [("lonely", 7, 0, None, None, "lonely")]
