"""Ids of pieces encoded by unit are those the tokenizer gives whole texts."""

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from velotide.llm import wavelet

ENCODER = wavelet.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
ODD = [
    None, "", " ", "   ", "\n", " lead", "trail ", "two  spaces", "tab\tx", "a b c  d", " x y",
    "a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>y z", "it's don't we'LL 'tis 's", "word,' end'. (x)-",
    "\x1c a\x85b", "a\x00b \x7f", "😀 ok 😀😀", "Ⅷ ½ x² ª º µ", "日本 語 a中", "\r\n\r\n x\n \n y", "naïve—word “q” …",
    "१२ abc ٣", "été ́", "Ꙁ\U0001e900 ꟶ", "snake_case __x__ 1a2b",
]


def _whole(text):
    return np.array(ENCODER.tokenizer.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()


def test_odd_texts():
    assert ENCODER(ODD) == list(map(_whole, ODD))
    assert ENCODER(ODD) == list(map(_whole, ODD))  # remembered


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" '.,\n\tst<|>aZéß1½—中"), st.characters(codec="utf-8"))), max_size=4))
def test_any_texts(texts):
    assert ENCODER(texts) == list(map(_whole, texts))


def test_pieces_are_forgotten(monkeypatch):
    monkeypatch.setattr(wavelet, "_REMEMBERED", 3)
    for text in ["a b c d e, f.", "g h i j k", "a g b h <|endoftext|>"]:
        assert ENCODER([text]) == [_whole(text)]
