"""The pieces query returns the pieces."""

from __future__ import annotations

import zlib

import numpy as np

from velotide.llm.queries import queries


def test_pieces_query_returns_ids(spark):
    rows = queries()["op9_sentence_pieces"](spark, "/root/testdata/sf0.001").collect()
    assert rows and all(len(r["piece_ids"]) == r["n_pieces"] for r in rows)
    assert all(zlib.crc32(np.array(r["piece_ids"], "<u4").tobytes()) == r["ids_crc32"] for r in rows)
