from velotide.llm import language

MODEL = language.LanguageModel(("a", "b"), 2, {"hello": [0.0, -9.0], "hallo": [-9.0, 0.0]}, {"h": [-1.0, -1.0]})


def _docs(spark):
    rows = [(1, "hello", "KEEP1", "own", 7), (2, "hallo hallo", None, "x", 8), (3, "...", "c", "d", 9), (4, None, "e", "f", 10)]
    return spark.createDataFrame(rows, "doc_id long, text string, score string, lang_pred string, _language int")


def test_kept_documents_are_as_they_came(spark):
    docs = _docs(spark)
    kept = language.confident(docs, MODEL)
    assert kept.schema == docs.schema
    assert sorted(map(tuple, kept.collect())) == [(1, "hello", "KEEP1", "own", 7), (2, "hallo hallo", None, "x", 8)]


def test_results_replace_columns_of_their_names_only(spark):
    got = {r.doc_id: (r.lang_pred, r._language) for r in language.identify(_docs(spark), MODEL).collect()}
    assert got == {1: ("a", 7), 2: ("b", 8), 3: ("und", 9), 4: ("und", 10)}


def test_repeated_rows_and_ties_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "hello"), (1, "hello"), (2, "h")], "doc_id long, text string")
    got = sorted(map(tuple, language.identify(docs, MODEL).select("doc_id", "lang_pred", "score").collect()))
    assert got[0] == got[1] and got[2] == (2, "a", 0.5)
    assert language.confident(docs.limit(0), MODEL).collect() == []


def test_whole_score_by_brute_force(spark):
    import math

    texts = {1: "hello hallo hello", 2: "hallo, HELLO! hallo", 3: "h hello"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for r in language.identify(docs, MODEL).collect():
        totals = [0.0, 0.0]
        for word in texts[r.doc_id].lower().replace(",", "").replace("!", "").split():
            for i, x in enumerate(MODEL.words.get(word, MODEL.grams.get(word, [0.0, 0.0]))):
                totals[i] += x
        odds = [math.exp(x) for x in totals]
        assert r.lang_pred == "ab"[odds.index(max(odds))]
        assert math.isclose(r.score, max(odds) / sum(odds), rel_tol=1e-12)
