"""What a Python worker keeps between batches and tasks stays small."""

import subprocess
import sys

import numpy as np
import public_tokenizers

from velotide.llm import gram_sets, sentence_pieces
from velotide.llm.queries import PIECES


def test_lattices_have_little_more_room_than_edges(monkeypatch):
    monkeypatch.setattr(sentence_pieces, "_EDGES_HELD", 100)
    model = public_tokenizers.path(PIECES)
    small = sentence_pieces.Sampler(model, 0.2, 0)
    units = {f" word{i} and {i}".encode() for i in range(500)}
    small.lattices.learn(units)
    assert 100 < small.lattices.edges <= len(small.lattices.keys) <= 1.2 * small.lattices.edges
    assert small.lattices.nodes <= len(small.lattices.first) <= 1.2 * small.lattices.nodes
    monkeypatch.undo()
    large = sentence_pieces.Sampler(model, 0.2, 0)
    texts = [b" ".join(sorted(units)), b"", None, b"one more"]
    for a, b in zip(small(list("abcd"), texts), large(list("abcd"), texts), strict=True):
        assert np.array_equal(a, b)


def test_gram_sets_hold_little():
    sets = gram_sets.GramSets(4)
    texts = [f"the {i} of {i // 3} and {i // 7} in".encode() * 9 for i in range(3_000)]
    assert sum(map(len, texts)) > 3 * gram_sets._CHUNK
    found = sets(texts)
    assert sets.up.nbytes + sets.down.nbytes <= 8 << 20
    assert all(np.array_equal(a, sets([t])[0]) for a, t in zip(found, texts, strict=True))


def test_language_needs_no_pandas():
    code = "import sys, velotide.llm.language; assert 'pandas' not in sys.modules"
    subprocess.run([sys.executable, "-c", code], check=True)
