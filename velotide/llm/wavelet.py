"""Token ids in wavelet matrices: one compressed file a shard, read at any place.

A wavelet matrix keeps one bit-plane for each bit of an id, highest first; each
plane orders the ids by the bits before it.  With the number of ones before
every block stored beside the blocks, reading an id, counting one and finding
its k-th place take one step for each bit.

File: ``WMX1``, length of the header (4 bytes), header (JSON), then parts that
are compressed one by one: document ids, document starts, and for each plane the
offsets of its blocks, the ones before each block, and the blocks.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from velotide.llm.common import rows_of, shuffle_partitions
from velotide.llm.shared import create_folder, new_name, open_source, write_bytes
from velotide.sources.scratch import materialize, scratch_path

_MAGIC = b"WMX1"
_BLOCK = 1 << 15  # bits
_END = 0  # the id that ends a document

# Tokens after which a task starts a new shard, and texts' pieces it remembers.
SHARD_TOKENS = 1 << 22
_REMEMBERED = 1_000_000

_SINGLE_SPACE = re.compile(r"(?<=\S) (?=\S)")

# The split of byte-level tokenizers, and characters whose classes
# no version of Unicode has changed.  Others are left to the tokenizer's own split.
_UNITS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_SETTLED = re.compile(r"[\t\n\r -~\u00A1-\u024F\u0400-\u0481\u2010-\u2027\u3041-\u3093\u30A1-\u30F6\u4E00-\u9FA5]*")
_MARKS = ".,;:!?%*\"'()-"
# Writers of so many little-endian 32-bit integers.
_FORMS = [struct.Struct(f"<{n}I").pack for n in range(32)]
# A lone surrogate, which no text holds; its byte is none of UTF-8.
_BETWEEN, _BETWEEN_BYTE = "\udcff", 0xFF


def planes(ids: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """Bit-planes of the ids, highest bit first; each stably sorts by the bit before."""
    for bit in range(bits - 1, -1, -1):
        ones = (ids >> bit & 1).astype(bool)
        yield ones
        ids = np.concatenate((np.compress(~ones, ids), np.compress(ones, ids)))


def pack(ids: np.ndarray, doc_ids: list[int | None], starts: list[int]) -> bytes:
    """A shard file of the ids and where its documents start."""
    bits = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    ids = ids.astype(np.uint16 if bits <= 16 else np.uint32)
    zipper = zstandard.ZstdCompressor(level=1)
    parts: list[bytes] = []
    size = 0
    header: dict = {"n": len(ids), "bits": bits, "docs": len(doc_ids), "planes": []}

    def add(data: bytes) -> list[int]:
        nonlocal size
        parts.append(zipper.compress(data))
        size += len(parts[-1])
        return [size - len(parts[-1]), len(parts[-1])]

    header["null_docs"] = [i for i, d in enumerate(doc_ids) if d is None]
    header["doc_ids"] = add(np.array([d or 0 for d in doc_ids], "<i8").tobytes())
    header["starts"] = add(np.array(starts, "<i8").tobytes())
    for ones in planes(ids, bits):
        packed = np.packbits(ones, bitorder="little").tobytes()
        blocks = [zipper.compress(packed[i : i + _BLOCK // 8]) for i in range(0, len(packed), _BLOCK // 8)]
        counts = [np.count_nonzero(ones[i : i + _BLOCK]) for i in range(0, len(ones), _BLOCK)]
        before = np.cumsum([0, *counts])
        offsets = np.concatenate(([0], np.cumsum([len(b) for b in blocks]))).astype("<i8")
        plane = {"zeros": int(len(ones) - before[-1]), "offsets": add(offsets.tobytes()), "ones": add(before.astype("<i8").tobytes())}
        plane["blocks"] = size
        parts += blocks
        size += int(offsets[-1])
        header["planes"].append(plane)
    head = json.dumps(header).encode()
    return b"".join([_MAGIC, len(head).to_bytes(4, "little"), head, *parts])


class WaveletMatrix:
    """A shard file, opened; only the directory is read before it is asked something."""

    def __init__(self, source):
        self.source = source
        source.seek(0)
        if source.read(4) != _MAGIC:
            raise ValueError("not a wavelet matrix file")
        length = int.from_bytes(source.read(4), "little")
        self.header = json.loads(source.read(length))
        self.base = 8 + length
        self.n, self.bits = self.header["n"], self.header["bits"]
        self.zeros = [p["zeros"] for p in self.header["planes"]]
        self.offsets = [self._numbers(p["offsets"]) for p in self.header["planes"]]
        self.ones_before = [self._numbers(p["ones"]) for p in self.header["planes"]]
        self.doc_ids = self._numbers(self.header["doc_ids"]).tolist()
        for i in self.header["null_docs"]:
            self.doc_ids[i] = None
        self.starts = self._numbers(self.header["starts"])
        self.block = lru_cache(maxsize=256)(self._block)

    def _read(self, offset: int, length: int) -> bytes:
        self.source.seek(self.base + offset)
        return self.source.read(length)

    def _numbers(self, part: list[int]) -> np.ndarray:
        return np.frombuffer(zstandard.ZstdDecompressor().decompress(self._read(*part)), "<i8")

    def _block(self, plane: int, i: int) -> np.ndarray:
        a, b = self.offsets[plane][i : i + 2].tolist()
        data = zstandard.ZstdDecompressor().decompress(self._read(self.header["planes"][plane]["blocks"] + a, b - a))
        return np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little").astype(bool)

    def _bit(self, plane: int, i: int) -> bool:
        return bool(self.block(plane, i // _BLOCK)[i % _BLOCK])

    def _rank(self, plane: int, i: int) -> int:
        """Ones before place i of a plane."""
        whole, rest = divmod(i, _BLOCK)
        return int(self.ones_before[plane][whole]) + (int(self.block(plane, whole)[:rest].sum()) if rest else 0)

    def _select(self, plane: int, bit: bool, k: int) -> int:
        """Place of the k-th (from 0) such bit of a plane."""
        before = self.ones_before[plane]
        if not bit:
            before = np.minimum(np.arange(len(before)) * _BLOCK, self.n) - before
        i = int(np.searchsorted(before, k, side="right")) - 1
        found = np.flatnonzero(self.block(plane, i) == bit)
        return i * _BLOCK + int(found[k - int(before[i])])

    def access(self, i: int) -> int:
        """The id at place i."""
        value = 0
        for plane in range(self.bits):
            bit, rank = self._bit(plane, i), self._rank(plane, i)
            value = value << 1 | bit
            i = self.zeros[plane] + rank if bit else i - rank
        return value

    def rank(self, value: int, i: int) -> int:
        """How often the id occurs before place i."""
        if value >> self.bits:
            return 0
        first = 0
        for plane in range(self.bits):
            a, b = self._rank(plane, first), self._rank(plane, i)
            if value >> (self.bits - 1 - plane) & 1:
                first, i = self.zeros[plane] + a, self.zeros[plane] + b
            else:
                first, i = first - a, i - b
        return i - first

    def count(self, value: int) -> int:
        return self.rank(value, self.n)

    def select(self, value: int, k: int) -> int:
        """Place of the k-th occurrence (from 0) of the id."""
        if not 0 <= k < self.count(value):
            raise IndexError(k)
        first = 0
        for plane in range(self.bits):
            a = self._rank(plane, first)
            first = self.zeros[plane] + a if value >> (self.bits - 1 - plane) & 1 else first - a
        i = first + k
        for plane in range(self.bits - 1, -1, -1):
            bit = bool(value >> (self.bits - 1 - plane) & 1)
            i = self._select(plane, bit, i - self.zeros[plane] if bit else i)
        return i

    def occurrences(self, value: int) -> list[int]:
        return [self.select(value, k) for k in range(self.count(value))]

    def tokens(self) -> np.ndarray:
        """All ids in order: the planes are undone from the last to the first."""
        ids = np.zeros(self.n, np.uint16 if self.bits <= 16 else np.uint32)
        unzip = zstandard.ZstdDecompressor()
        for plane in range(self.bits - 1, -1, -1):
            offsets = self.offsets[plane]
            body = self._read(self.header["planes"][plane]["blocks"], int(offsets[-1]))
            packed = b"".join(unzip.decompress(body[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True))
            ones = np.unpackbits(np.frombuffer(packed, np.uint8), count=self.n, bitorder="little").view(bool)
            ids_before = np.empty_like(ids)
            ids_before[~ones] = ids[: self.zeros[plane]]
            ids_before[ones] = ids[self.zeros[plane] :] | ids.dtype.type(1 << (self.bits - 1 - plane))
            ids = ids_before
        return ids


def byte_characters() -> dict[int, str]:
    """The visible character that stands for each byte in a byte-level vocabulary."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b != 0xAD]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Encoder:
    """Ids of whole texts, as little-endian 32-bit integers.

    A byte-level tokenizer never joins what lies on both sides of a single space
    between two other characters, so texts are cut there and what repeats is
    encoded once.  New pieces are cut into the units the tokenizer merges
    within, and its model encodes every new unit; pieces with unusual characters
    or added tokens are left whole to the tokenizer.
    """

    def __init__(self, tokenizer: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer)
        self.model = self.tokenizer.model
        kind = json.loads(self.tokenizer.to_str())
        split = kind["pre_tokenizer"] or {}
        self.added = [t["content"] for t in kind["added_tokens"]]
        unusual = [re.escape(t) for t in self.added]
        self.unusual = re.compile("|".join(unusual)).search if unusual else lambda piece: None
        self.cuts = (
            not any(kind[k] for k in ("normalizer", "truncation", "padding"))
            and split.get("type") == "ByteLevel"
            and split.get("use_regex", True)
            and not split["add_prefix_space"]
            and not any(" " in t or t.isalpha() for t in self.added)
        )
        self.shown = byte_characters()
        self.first: dict[str, bytes] = {}
        self.later: dict[str, bytes] = {}
        self.units: dict[str, bytes] = {}

    def _pieces(self, text: str) -> list[str]:
        if not self.cuts:
            return [text]
        pieces = text.split(" ")
        if "" in pieces or list(map(str.strip, pieces)) != pieces:
            pieces = _SINGLE_SPACE.split(text)
        return pieces

    def _learn(self, known: dict[str, bytes], pieces: set[str], lead: str) -> None:
        if len(known) > _REMEMBERED:
            known.clear()
        whole, letters, cut = [], [], {}
        settled, unusual, units_of = _SETTLED.fullmatch, self.unusual, _UNITS.findall
        for piece in pieces.difference(known):
            if not self.cuts or not (piece.isascii() and piece.isprintable() or settled(piece)):
                whole.append(piece)
            elif piece.isalpha():  # one unit
                letters.append(piece)
            elif unusual(piece):
                whole.append(piece)
            elif (word := piece.rstrip(_MARKS)).isalpha():  # two units
                cut[piece] = (lead + word, piece[len(word) :])
            else:
                cut[piece] = units_of(lead + piece)
        for start in range(0, len(whole), 10_000):
            part = whole[start : start + 10_000]
            for piece, e in zip(part, self.tokenizer.encode_batch([lead + p for p in part], add_special_tokens=False), strict=True):
                known[piece] = np.array(e.ids, "<u4").tobytes()
        units = {lead + piece for piece in letters}
        units.update(*cut.values())
        self._learn_units(units)
        for piece in letters:
            known[piece] = self.units[lead + piece]
        for piece, parts in cut.items():
            known[piece] = b"".join([self.units[u] for u in parts])

    def _learn_units(self, units: set[str]) -> None:
        if len(self.units) > _REMEMBERED:
            self.units.clear()
        new = list(units.difference(self.units))
        if not new:
            return
        octets = _BETWEEN.join(new).encode("utf-8", "surrogateescape")
        shown = octets.decode("latin-1").translate(self.shown).split(self.shown[_BETWEEN_BYTE])
        tokenize = self.model.tokenize
        for unit, body in zip(new, shown, strict=True):
            ids = [t.id for t in tokenize(body)]
            self.units[unit] = _FORMS[len(ids)](*ids) if len(ids) < len(_FORMS) else np.array(ids, "<u4").tobytes()

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        cut = [self._pieces(t) if t else [""] for t in texts]
        heads = [c[0] for c in cut]
        self._learn(self.first, set(heads), "")
        for c in cut:
            del c[0]
        self._learn(self.later, set().union(*cut), " ")
        later = self.later.__getitem__
        return [b"".join([self.first[head], *map(later, c)]) for head, c in zip(heads, cut, strict=True)]


@lru_cache(maxsize=1)
def encoder(tokenizer: str) -> Encoder:
    """A worker's encoder: what it has encoded serves its next tasks too."""
    return Encoder(tokenizer)


def write_shards(docs: DataFrame, tokenizer: str, folder: str) -> DataFrame:
    """Encoded documents in ascending doc_id order: ``(part, place, path, docs, tokens)``, a row a file.

    Ranges of doc_id are dealt to tasks, and ``part, place`` order the files.
    Each document is followed by id 0.  Null ids come first; rows of one doc_id
    are in the order of their text's hash.
    """
    order = ["doc_id", F.xxhash64("text")]
    dealt = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange(shuffle_partitions(docs.sparkSession), *order)
    end = np.array([_END], "<u4").tobytes()

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        part, place = TaskContext.get().partitionId(), 0
        held, doc_ids, starts, tokens = [], [], [], 0

        def shard() -> pa.RecordBatch:
            path = new_name(folder, f"tokens-{part:06d}-{place:04d}", ".wmx")
            write_bytes(path, pack(np.frombuffer(b"".join(held), "<u4"), doc_ids, starts))
            row = {"part": part, "place": place, "path": path, "docs": len(doc_ids), "tokens": tokens}
            return pa.RecordBatch.from_pylist([row])

        for ids, texts in rows_of(batches, "doc_id", "text"):
            for doc_id, body in zip(ids, encode(texts), strict=True):
                doc_ids.append(doc_id)
                starts.append(tokens)
                held += [body, end]
                tokens += len(body) // 4 + 1
                if tokens >= SHARD_TOKENS:
                    yield shard()
                    place, tokens = place + 1, 0
                    held, doc_ids, starts = [], [], []
        if doc_ids:
            yield shard()

    return dealt.sortWithinPartitions(*order).mapInArrow(written, "part long, place long, path string, docs long, tokens long")


def read_shards(files: DataFrame) -> DataFrame:
    """Every document of shard ``files(path, first)``: ``doc_id, start, n_tokens, ids_crc32``.

    ``first`` is the number of ids in all files before.
    """
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for paths, firsts in rows_of(batches, "path", "first"):
            for path, first in zip(paths, firsts, strict=True):
                with open_source(path) as source:
                    matrix = WaveletMatrix(source)
                    ids = matrix.tokens().astype("<u4")
                starts = matrix.starts
                ends = np.append(starts[1:], matrix.n)
                sums = [zlib.crc32(ids[a:b].data) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                columns = [matrix.doc_ids, starts + first, ends - starts, sums]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    return files.mapInArrow(read, ", ".join(f"{n} long" for n in names))


def tokenised(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Documents written to wavelet shards and read back; see ``read_shards``.

    A null text is encoded as an empty one.  Columns other than doc_id and text
    are ignored.
    """
    folder = scratch_path(docs.sparkSession, "tokens")
    create_folder(folder)
    files = materialize(write_shards(docs, tokenizer, folder), "token-files")
    before = Window.orderBy("part", "place").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.withColumn("first", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    return read_shards(placed.select("path", "first").repartition(max(1, files.count())))
