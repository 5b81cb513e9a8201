"""Language ID: known words first, shorter and shorter character n-grams for the rest."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velotide.sources.scratch import materialize

UNKNOWN = "und"
_LETTERS = re.compile(r"[^\W\d_]+")
_SMOOTHING = 0.5


@dataclass(frozen=True)
class LanguageModel:
    """Log frequencies per language of words and of n-grams of ``max_order`` letters at most."""

    languages: tuple[str, ...]
    max_order: int
    words: dict[str, list[float]] = field(repr=False)
    grams: dict[str, list[float]] = field(repr=False)


def fit(
    docs: DataFrame,
    *,
    fit_rows: int = 3_000,
    max_words: int = 50_000,
    max_grams: int = 20_000,
    max_order: int = 4,
) -> LanguageModel:
    """Learn from ``text`` and ``lang`` of ``docs``.

    ``fit_rows`` bounds the sample: about so many documents of each language are
    drawn by a hash of doc_id (all of them where a language has fewer), and the
    whole text of a drawn document counts.  ``max_words`` and, for each order,
    ``max_grams`` bound the model: the most frequent over all languages are
    kept, rarer ones are scored by shorter n-grams like unseen ones.  Rows with
    a null text or lang teach nothing; without any usable row the model knows no
    language and predicts ``und``.  Other columns are ignored.
    """
    usable = docs.select("doc_id", "text", "lang").filter(F.col("text").isNotNull() & F.col("lang").isNotNull())
    rows = {r["lang"]: r["rows"] for r in usable.groupBy("lang").agg(F.count(F.lit(1)).alias("rows")).collect()}
    if not rows:
        return LanguageModel((), max_order, {}, {})
    steps = 1 << 30
    share = F.create_map(*[F.lit(x) for lang, n in rows.items() for x in (lang, int(steps * min(1.0, fit_rows / n)))])
    drawn = usable.filter(F.pmod(F.xxhash64(F.lit("fit"), "doc_id"), F.lit(steps)) < share[F.col("lang")])

    words = materialize(
        drawn.select("lang", F.explode(F.expr(r"regexp_extract_all(lower(text), '\\p{L}+', 0)")).alias("item"))
        .groupBy("lang", "item")
        .agg(F.count(F.lit(1)).alias("n")),
        "words",
    )
    padded = words.select("lang", "n", F.concat(F.lit(" "), "item", F.lit(" ")).alias("word"))
    grams = materialize(
        padded.withColumn("order", F.explode(F.sequence(F.lit(1), F.lit(max_order))))
        .filter(F.length("word") >= F.col("order"))
        .select(
            "lang",
            "n",
            "order",
            F.explode(
                F.transform(
                    F.sequence(F.lit(1), F.length("word") - F.col("order") + 1),
                    lambda i: F.substring(F.col("word"), i, F.col("order")),
                )
            ).alias("item"),
        )
        .groupBy("lang", "order", "item")
        .agg(F.sum("n").alias("n")),
        "grams",
    )
    languages = tuple(sorted(rows))
    known_words = _log_frequencies(words.withColumn("order", F.lit(0)), languages, {0: max_words})
    known_grams = _log_frequencies(grams, languages, dict.fromkeys(range(1, max_order + 1), max_grams))
    return LanguageModel(languages, max_order, known_words, known_grams)


def _log_frequencies(counts: DataFrame, languages: tuple[str, ...], most: dict[int, int]) -> dict[str, list[float]]:
    """Smoothed log shares of the most frequent items of each order."""
    by_item = counts.groupBy("order", "item").agg(
        F.sum("n").alias("total"),
        F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by_lang"),
    )
    totals = {(r["order"], r["lang"]): r["n"] for r in counts.groupBy("order", "lang").agg(F.sum("n").alias("n")).collect()}
    known: dict[str, list[float]] = {}
    for order, limit in most.items():
        top = by_item.filter(F.col("order") == order).orderBy(F.desc("total"), "item").limit(limit)
        items = [(r["item"], r["by_lang"]) for r in top.select("item", "by_lang").collect()]
        for item, by_lang in items:
            known[item] = [
                math.log(
                    (by_lang.get(lang, 0) + _SMOOTHING)
                    / (totals.get((order, lang), 0) + _SMOOTHING * (len(items) + 1))
                )
                for lang in languages
            ]
    return known


class Scorer(dict):
    """Rows of a score matrix by word; a word that is not there yet is scored and added."""

    # Scored unseen words held at once; then they are forgotten and scored anew.
    _HELD = 200_000

    def __init__(self, model: LanguageModel):
        super().__init__()
        self.model = model
        self.known = {w: i for i, w in enumerate(model.words)}
        self.scores = np.zeros((len(self.known) + self._HELD + 1, len(model.languages)))
        if self.known:
            self.scores[: len(self.known)] = list(model.words.values())
        self._forget()

    def _forget(self) -> None:
        self.clear()
        self.update(self.known)

    def __missing__(self, word: str) -> int:
        row = len(self)
        self.scores[row] = self._backoff(word)
        self[word] = row
        return row

    def _backoff(self, word: str) -> np.ndarray | float:
        """Mean score of the longest n-grams of which any is known."""
        padded, grams = f" {word} ", self.model.grams
        for order in range(self.model.max_order, 0, -1):
            found = [s for i in range(len(padded) - order + 1) if (s := grams.get(padded[i : i + order]))]
            if found:
                return np.mean(found, axis=0)
        return 0.0

    def predict(self, text: str | None) -> tuple[str, float]:
        words = _LETTERS.findall(text.lower()) if text else []
        if not self.model.languages or not any(c.isalpha() for w in words for c in w):
            return UNKNOWN, 0.0
        total = np.zeros(len(self.model.languages))
        for start in range(0, len(words), 50_000):
            part = words[start : start + 50_000]
            if len(self) + len(part) > len(self.scores):
                self._forget()
            total += self.scores[list(map(self.__getitem__, part))].sum(axis=0)
        odds = np.exp(total - total.max())
        best = int(odds.argmax())
        return self.model.languages[best], float(odds[best] / odds.sum())


def _scored(docs: DataFrame, model: LanguageModel) -> tuple[DataFrame, str]:
    """``docs`` with a struct of ``lang_pred`` and ``score``, and its name, which no column has."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def predicted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(shared.value)
        for texts in batches:
            found = [scorer.predict(t) for t in texts.to_pylist()]
            columns = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.StructArray.from_arrays(columns, ["lang_pred", "score"])

    name, taken = "_language", {c.lower() for c in docs.columns}
    while name in taken:
        name = f"_{name}"
    return docs.withColumn(name, predicted(F.col("text"))), name


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the probability of that language.

    Only the text is looked at, and all of it.  A null text or one without a
    letter is ``und`` with score 0.  Ties go to the language first in order.
    Columns of those names are replaced, others are passed through.
    """
    found, name = _scored(docs.drop("lang_pred", "score"), model)
    return found.select("*", f"{name}.lang_pred", f"{name}.score").drop(name)


def confident(docs: DataFrame, model: LanguageModel, min_score: float = 0.5) -> DataFrame:
    """The documents with a language: ``und`` and scores below ``min_score`` go.

    Kept rows are as they came, in columns named like the results too.
    """
    found, name = _scored(docs, model)
    return found.filter((F.col(f"{name}.lang_pred") != UNKNOWN) & (F.col(f"{name}.score") >= min_score)).drop(name)
