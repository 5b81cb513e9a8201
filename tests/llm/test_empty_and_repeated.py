"""Empty tables, null and repeated ids of the n-gram join and the token files."""

import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from velotide.llm import ngram_join, wavelet

MODEL = public_tokenizers.path("byte_bpe_50k.json")


def test_link_counts_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_join.link_counts(docs).collect() == []


def test_tokens_of_null_and_repeated_ids(spark):
    rows = [(2, "two"), (None, "no id"), (1, "one"), (1, "one"), (1, "another one"), (None, None), (3, ""), (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(wavelet.tokenised(docs, MODEL).collect(), key=lambda r: r["start"])
    tokenizer = Tokenizer.from_file(MODEL)

    def facts(doc_id, text):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        return doc_id if doc_id is not None else -1, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())

    found = [(r["doc_id"] if r["doc_id"] is not None else -1, r["n_tokens"], r["ids_crc32"]) for r in got]
    assert sorted(found) == sorted(facts(*r) for r in rows)
    assert [f[0] for f in found] == [-1, -1, -1, 1, 1, 1, 2, 3]
    starts = [r["start"] for r in got]
    assert starts == [0, *np.cumsum([r["n_tokens"] for r in got])[:-1].tolist()]
