"""The whole score of the language model, computed again in plain Python."""

import math
from collections import Counter

import pytest
import regex

from velotide.llm import language

SCHEMA = "doc_id long, text string, lang string, score string"
ROWS = [
    (1, "the house and the garden, the sea", "en", "x"),
    (2, "a dog in the house; the cat and the mouse", "en", None),
    (3, "das haus und der garten, das meer", "de", "x"),
    (4, "der hund im haus; die katze und die maus über", "de", None),
    (4, "der hund im haus; die katze und die maus über", "de", None),  # a repeated row counts twice
    (5, "le chat et la souris, la mer", "fr", "x"),
    (6, None, "fr", "x"),
    (7, "", "fr", "x"),
    (8, "nothing to learn here", None, "x"),
    (None, "la maison et le jardin", "fr", "x"),
]
ASKED = [
    "the garden", "der garten", "la maison", "GARTENHAUS katzen", "souriceau", "zzz", "x", "12 34 --", "", None,
    "the der la", "über-haus, the 3 mice", "qqq " * 200 + "jardin", "dogs " * 60_001,
]


def _kept(counts: dict[str, Counter], limit: int) -> dict[str, dict[str, float]]:
    totals = Counter()
    for c in counts.values():
        totals.update(c)
    items = sorted(totals, key=lambda item: (-totals[item], item.encode()))[:limit]
    return {
        item: {lang: math.log((c[item] + 0.5) / (sum(c.values()) + 0.5 * (len(items) + 1))) for lang, c in counts.items()}
        for item in items
    }


def _brute_force(rows, max_words: int, max_grams: int, max_order: int):
    words = {lang: Counter() for _, text, lang, _ in rows if text is not None and lang is not None}
    for doc_id, text, lang, _ in rows:
        if text is not None and lang is not None:
            words[lang].update(regex.findall(r"\p{L}+", text.lower()))
    known, grams = _kept(words, max_words), {}
    for order in range(1, max_order + 1):
        counts = {lang: Counter() for lang in words}
        for lang, c in words.items():
            for word, n in c.items():
                padded = f" {word} "
                for i in range(len(padded) - order + 1):
                    counts[lang][padded[i : i + order]] += n
        grams[order] = _kept(counts, max_grams)

    def of_word(word: str) -> dict[str, float]:
        if word in known:
            return known[word]
        padded = f" {word} "
        for order in range(max_order, 0, -1):
            found = [grams[order][g] for i in range(len(padded) - order + 1) if (g := padded[i : i + order]) in grams[order]]
            if found:
                return {lang: sum(f[lang] for f in found) / len(found) for lang in words}
        return dict.fromkeys(words, 0.0)

    def predict(text):
        total = Counter()
        found = regex.findall(r"\p{L}+", (text or "").lower())
        if not found:
            return "und", 0.0
        for word in found:
            for lang, score in of_word(word).items():
                total[lang] += score
        best = max(sorted(words), key=lambda lang: total[lang])
        return best, 1 / sum(math.exp(total[lang] - total[best]) for lang in words)

    return predict


@pytest.mark.parametrize("limits", [(50_000, 20_000, 4), (6, 12, 3), (1, 3, 1)])
def test_scores_equal_a_plain_computation(spark, limits):
    max_words, max_grams, max_order = limits
    docs = spark.createDataFrame(ROWS, SCHEMA)
    model = language.fit(docs, max_words=max_words, max_grams=max_grams, max_order=max_order)
    asked = spark.createDataFrame(list(enumerate(ASKED)), "doc_id long, text string")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.identify(asked, model).collect()}
    predict = _brute_force(ROWS, *limits)
    for i, text in enumerate(ASKED):
        lang, score = predict(text)
        assert got[i][1] == pytest.approx(score, abs=1e-9), text
        assert got[i][0] == lang or score == pytest.approx(got[i][1], abs=1e-12), text
