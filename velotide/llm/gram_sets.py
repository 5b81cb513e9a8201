"""Word n-gram sets of many texts at once, as sorted 64-bit hashes."""

from __future__ import annotations

import numpy as np

# Bytes hashed at once, some 50 bytes of memory each; a text is cut between words.
_CHUNK = 1 << 17
_STEP = np.uint64(0x9E3779B97F4A7C15 | 1)

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BREAKS = b" \t\n\v\f\r"


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits in which every input bit matters (a published finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# A random number for every byte, the same for A-Z and a-z.
_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_VALUES[ord("A") : ord("Z") + 1] = _VALUES[ord("a") : ord("z") + 1]


class GramSets:
    """Sets of the distinct n-grams of words, hashed.

    Words are runs of bytes other than space and tab to return, with A-Z
    lowered.  A text with fewer than n words has one gram of all of them, one
    without words none.
    """

    def __init__(self, n: int):
        self.n = n
        self._powers(2 * _CHUNK)

    def _powers(self, size: int) -> None:
        """Powers of an odd number and of its inverse, modulo 2**64."""
        inverse = np.uint64(pow(int(_STEP), -1, 1 << 64))
        self.up, self.down = np.full(size, _STEP), np.full(size, inverse)
        self.up[0] = self.down[0] = 1
        np.multiply.accumulate(self.up, out=self.up)
        np.multiply.accumulate(self.down, out=self.down)

    def __call__(self, texts: list[bytes | None]) -> list[np.ndarray]:
        found: list[np.ndarray] = []
        start = 0
        while start < len(texts):
            end, size = start + 1, len(texts[start] or b"")
            while end < len(texts) and size + len(texts[end] or b"") < _CHUNK:
                size += len(texts[end] or b"") + 1
                end += 1
            found += self._part([t or b"" for t in texts[start:end]])
            start = end
        return found

    def _part(self, texts: list[bytes]) -> list[np.ndarray]:
        if len(texts) == 1 and len(texts[0]) > _CHUNK:
            words = np.concatenate([self._words(piece)[0] for piece in _pieces(texts[0])])
            ends = [len(words)]
        else:
            words, starts = self._words(b" ".join(texts))
            last = np.cumsum([len(t) + 1 for t in texts])
            ends = np.searchsorted(starts, last).tolist()
        grams = self._grams(words, self.n) if len(words) >= self.n else None
        found, first = [], 0
        for end in ends:
            count = end - first
            if count >= self.n:
                found.append(_distinct(grams[first : end - self.n + 1]))
            elif count:
                found.append(self._grams(words[first:end], count))
            else:
                found.append(np.empty(0, np.uint64))
            first = end
        return found

    def _words(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Hash and start of every word."""
        data = np.frombuffer(text, np.uint8)
        if len(data) >= len(self.up):
            self._powers(2 * len(data))
        inside = np.concatenate(([False], ~_SPACE[data], [False]))
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[::2], edges[1::2]
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_VALUES[data] * self.up[: len(data)], out=sums[1:])
        return mixed((sums[ends] - sums[starts]) * self.down[starts]), starts

    @staticmethod
    def _grams(words: np.ndarray, width: int) -> np.ndarray:
        grams = np.full(len(words) - width + 1, width, np.uint64)
        for i in range(width):
            grams = mixed(grams ^ words[i : len(words) - width + 1 + i])
        return grams


def _distinct(grams: np.ndarray) -> np.ndarray:
    ordered = np.sort(grams)
    return ordered[np.concatenate(([True], ordered[1:] != ordered[:-1]))]


def _pieces(text: bytes):
    """Parts of a long text, cut at its spaces."""
    start = 0
    while start < len(text):
        end = min(start + _CHUNK, len(text))
        while end < len(text) and text[end] not in _BREAKS:
            end += 1
        yield text[start:end]
        start = end
