"""Sampled segmentations over a piece lattice, and lossless decoding.

The pieces of a SentencePiece model span a lattice over a text.  Forward sums
give the weight of all ways to each place; walking backward, each piece is drawn
in proportion to the ways it completes.  The draws depend on the row's key, so a
text is always cut the same way.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velotide.llm.common import octets
from velotide.llm.gram_sets import mixed

_UNITS = re.compile(rb"\n| *[^ \n]+| +")
# A unit always ends here.
_BREAK = re.compile(rb"(?<=[^ \n])[ \n]")
_SPACE = "▁"

# Distinct units and lattice edges a task remembers, units added and bytes of
# text cut at once, and ids decoded at once: a worker's memory does not depend
# on the length of texts but for the text and its ids.
_UNITS_HELD = 100_000
_EDGES_HELD = 2_000_000
_UNITS_AT_ONCE = 4_096
_TEXT_AT_ONCE = 1 << 18
_IDS_AT_ONCE = 1 << 16

# Units up to this length are added many at once, and need no scaling.
_SHORT = 48

# Places after which the sums of ways are scaled: weights are at least about
# 1e-6, so no product of so many, or of a piece's length more, is out of range.
_SCALED_EVERY = 16


class Pieces:
    """Pieces of a model as bytes, with a weight each.

    A BPE model has ranks, no probabilities; a piece's weight follows its rank
    by Zipf's law, raised to ``alpha`` (0 to 1): smaller values cut more evenly.
    """

    def __init__(self, model: str, alpha: float):
        if not 0 <= alpha <= 1:
            raise ValueError(f"alpha must be from 0 to 1: {alpha}")
        processor = sentencepiece.SentencePieceProcessor(model_file=model)
        self.bytes: list[bytes] = []
        self.byte_ids = [0] * 256
        ordinary = []
        for i in range(processor.get_piece_size()):
            piece = processor.id_to_piece(i)
            if processor.is_byte(i):
                value = int(piece[3:-1], 16)
                self.byte_ids[value] = i
                self.bytes.append(bytes([value]))
            elif processor.is_control(i) or processor.is_unknown(i):
                self.bytes.append(b"")
            else:
                self.bytes.append(piece.replace(_SPACE, " ").encode())
                ordinary.append((-processor.get_score(i), i))
        if not all(self.byte_ids):
            raise ValueError("the model has no piece for every byte")
        self.weights = [0.0] * len(self.bytes)
        for rank, (_, i) in enumerate(sorted(ordinary)):
            self.weights[i] = (1.0 / (rank + 2)) ** alpha
        least = min(self.weights[i] for _, i in ordinary)
        for i in self.byte_ids:
            self.weights[i] = least
        self.longest = max(4, *(len(self.bytes[i]) for _, i in ordinary))
        # Pieces, and as -1 the beginnings of pieces.
        self.ids: dict[bytes, int] = {}
        for _, i in ordinary:
            piece = self.bytes[i]
            if b" " in piece.lstrip(b" ") or b"\n" in piece:
                raise ValueError(f"piece {i} crosses units")
            for end in range(1, len(piece)):
                self.ids.setdefault(piece[:end], -1)
            self.ids[piece] = i
        self._number_beginnings()

    def _number_beginnings(self) -> None:
        """The same as sorted steps ``beginning << 8 | byte``, for walks of many texts at once."""
        number = {b"": 0}
        for beginning in self.ids:
            number[beginning] = len(number)
        steps = sorted((number[b[:-1]] << 8 | b[-1], number[b]) for b in self.ids)
        self.steps, self.step_to = (np.array(x, np.int64) for x in zip(*steps, strict=True))
        self.roots = np.array([number.get(bytes([i]), -1) for i in range(256)], np.int64)
        self.piece_of = np.array([-1, *self.ids.values()], np.int32)
        self.weight = np.array(self.weights)
        self.byte_id = np.array(self.byte_ids, np.int32)


@lru_cache(maxsize=2)
def pieces(model: str, alpha: float) -> Pieces:
    return Pieces(model, alpha)


def _width(lead: int) -> int:
    return 1 if lead < 0xC0 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4


def _is_text(unit: bytes) -> bool:
    try:
        return unit.isascii() or unit.decode() is not None
    except UnicodeDecodeError:
        return False


def _grown(array: np.ndarray, used: int, needed: int) -> np.ndarray:
    """The used entries in an array with room for those needed and an eighth more; the rest is not touched."""
    larger = np.empty(needed + needed // 8, array.dtype)
    larger[:used] = array[:used]
    return larger


class Lattices:
    """Lattices of distinct units, ready for drawing.

    A unit is a newline, or spaces and what follows them up to the next: no
    piece crosses units, so the lattice of a text is the chain of theirs.  The
    edges into a node are stored side by side with their cumulative shares, in
    one array for all units, so that a draw for many units at once walks from
    the first edge of each node.
    """

    def __init__(self, table: Pieces):
        self.table = table
        self.keys = np.empty(_EDGES_HELD)
        self.back = np.empty(_EDGES_HELD, np.int32)
        self.piece = np.empty(_EDGES_HELD, np.int32)
        self.first = np.empty(_EDGES_HELD, np.int32)
        self.forget()

    def forget(self) -> None:
        self.units: dict[bytes, int] = {}
        self.ends: list[int] = []
        self.edges = self.nodes = 0

    def learn(self, units: set[bytes]) -> None:
        short, rest = [], []
        for unit in units.difference(self.units):
            (short if len(unit) <= _SHORT and _is_text(unit) else rest).append(unit)
        for start in range(0, len(short), _UNITS_AT_ONCE):
            self._add_many(short[start : start + _UNITS_AT_ONCE])
        for unit in rest:
            self._add(unit)

    def _store(self, units: list[bytes], keys, back, piece, first) -> None:
        """Keeps edges, and for each node of the units in turn where its edges begin."""
        a, b = self.edges, self.edges + len(keys)
        if b > len(self.keys):
            self.keys, self.back, self.piece = (_grown(x, a, b) for x in (self.keys, self.back, self.piece))
        node = self.nodes + len(first)
        if node > len(self.first):
            self.first = _grown(self.first, self.nodes, node)
        self.keys[a:b], self.back[a:b], self.piece[a:b] = keys, back, piece
        self.first[self.nodes : node] = first
        ends = self.nodes - 1 + np.cumsum([len(u) + 1 for u in units])
        self.units.update(zip(units, range(len(self.ends), len(self.ends) + len(units)), strict=True))
        self.ends += ends.tolist()
        self.edges, self.nodes = b, node

    def room(self) -> bool:
        return len(self.units) < _UNITS_HELD and self.edges < _EDGES_HELD

    def _edges_into(self, unit: bytes) -> list[list[tuple[int, int]]]:
        """For every place in the unit, (start, piece) of the pieces that end there."""
        get, byte_ids, size = self.table.ids.get, self.table.byte_ids, len(unit)
        into: list[list[tuple[int, int]]] = [[] for _ in range(size + 1)]
        at = 0
        while at < size:
            width = min(_width(unit[at]), size - at)
            for end in range(at + 1, size + 1):
                found = get(unit[at:end])
                if found is None:
                    break
                if found >= 0:
                    into[end].append((at, found))
            if get(unit[at : at + width], -1) < 0:
                for i in range(at, at + width):
                    into[i + 1].append((i, byte_ids[unit[i]]))
            at += width
        return into

    def _add(self, unit: bytes) -> None:
        """One unit of any length and content; its sums are scaled as they grow small."""
        into, weights, base = self._edges_into(unit), self.table.weights, self.nodes
        ways, keys, back, piece, first = [1.0], [], [], [], [self.edges]
        for at in range(1, len(into)):
            first.append(self.edges + len(keys))
            total = 0.0
            shares = []
            for start, i in into[at]:
                total += ways[start] * weights[i]
                shares.append(total)
                back.append(base + start)
                piece.append(i)
            ways.append(total)
            keys += [s / total for s in shares]
            if at % _SCALED_EVERY == 0:
                near = ways[-self.table.longest :]
                most = max(near)
                ways[-self.table.longest :] = [w / most for w in near]
        self._store([unit], keys, back, piece, first)

    def _edges_of_many(self, data: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Begin, end and piece of all edges in UTF-8 bytes whose units end at ``stop``."""
        table = self.table
        begin = np.flatnonzero(data & 0xC0 != 0x80)
        width = np.diff(begin, append=len(data))
        whole = np.zeros(len(begin), bool)
        who, state, found = np.arange(len(begin)), np.zeros(len(begin), np.int64), []
        for k in range(table.longest):
            at = begin[who] + k
            inside = at < stop[begin[who]]
            who, state, at = who[inside], state[inside], at[inside]
            if k:
                step = state << 8 | data[at]
                i = np.minimum(np.searchsorted(table.steps, step), len(table.steps) - 1)
                state = np.where(table.steps[i] == step, table.step_to[i], -1)
            else:
                state = table.roots[data[at]]
            who, state = who[state >= 0], state[state >= 0]
            if not len(who):
                break
            piece = table.piece_of[state]
            ends = piece >= 0
            found.append((begin[who[ends]], begin[who[ends]] + k + 1, piece[ends]))
            whole[who[ends & (width[who] == k + 1)]] = True
        single = np.flatnonzero(np.repeat(~whole, width))
        found.append((single, single + 1, table.byte_id[data[single]]))
        a, b, piece = (np.concatenate(x) for x in zip(*found, strict=True))
        return a, b, piece

    def _add_many(self, units: list[bytes]) -> None:
        """Short units of valid UTF-8: the sums go place by place through all of them."""
        lengths = np.fromiter(map(len, units), np.int64, len(units))
        unit = np.repeat(np.arange(len(units)), lengths)
        stop = np.cumsum(lengths)
        a, b, piece = self._edges_of_many(np.frombuffer(b"".join(units), np.uint8), stop[unit])
        # A unit has one node more than bytes.
        start, end = a + unit[a], b + unit[a]
        place = b - (stop - lengths)[unit[a]]
        # One number a row sorts much faster than two columns do.
        order = np.argsort(end << 32 | start)
        start, end, piece, place = start[order], end[order], piece[order], place[order]
        into = np.bincount(end, minlength=len(unit) + len(units))
        first = np.cumsum(into) - into
        rank = np.arange(len(end)) - first[end]
        weight, sums = self.table.weight[piece], np.empty(len(end))
        ways = np.ones(len(first))
        turn = np.argsort((place << 8 | rank) << 32 | np.arange(len(end)))
        changes = np.flatnonzero(np.diff(place[turn] << 32 | rank[turn])) + 1
        for edge in np.split(turn, changes):
            added = ways[start[edge]] * weight[edge]
            sums[edge] = added if rank[edge[0]] == 0 else sums[edge - 1] + added
            ways[end[edge]] = sums[edge]
        self._store(units, sums / ways[end], start + self.nodes, piece, first + self.edges)

    def draw(self, units: list[bytes], seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all units in order, and how many each has."""
        which = np.fromiter(map(self.units.__getitem__, units), np.int64, len(units))
        sizes = np.fromiter(map(len, units), np.int64, len(units))
        node = np.array(self.ends, np.int64)[which]
        begin = node - sizes
        active, steps = np.arange(len(units)), []
        counts = np.zeros(len(units), np.int64)
        step = 0
        while len(active):
            random = mixed(seeds[active] + np.uint64(step * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
            share = (random >> np.uint64(11)).astype(np.float64) * 2.0**-53
            # An edge's key is the upper end of its share; that of a node's last is 1.
            edge = self.first[node]
            on = np.flatnonzero(self.keys[edge] <= share)
            while len(on):
                edge[on] += 1
                on = on[self.keys[edge[on]] <= share[on]]
            steps.append((active, self.piece[edge]))
            counts[active] += 1
            node = self.back[edge].astype(np.int64)
            going = node != begin[active]
            active, node = active[going], node[going]
            step += 1
        last = np.cumsum(counts)
        ids = np.empty(int(last[-1]) if len(last) else 0, np.int32)
        for i, (who, piece) in enumerate(steps):
            ids[last[who] - 1 - i] = piece
        return ids, counts


def _seed(key: str | None, seed: int) -> int:
    return xxhash.xxh3_64_intdigest(key.encode() if key is not None else b"\x00null", seed=seed)


class Sampler:
    def __init__(self, model: str, alpha: float, seed: int):
        self.lattices, self.seed = Lattices(pieces(model, alpha)), seed

    def __call__(self, keys: list, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in order, and how many each has."""
        seeds = np.array([_seed(k, self.seed) for k in keys], np.uint64)
        counts, places, ids = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64), [np.empty(0, np.int32)]
        rows, bodies, size = [], [], 0

        def draw() -> None:
            if not self.lattices.room():
                self.lattices.forget()
            cut = [_UNITS.findall(b) for b in bodies]
            units = [u for c in cut for u in c]
            self.lattices.learn(set(units))
            lengths = np.array([len(c) for c in cut])
            row = np.repeat(rows, lengths)
            # A row's first part here goes on where the last one ended.
            place = np.concatenate([np.arange(places[r], places[r] + n) for r, n in zip(rows, lengths, strict=True)])
            found, each = self.lattices.draw(units, mixed(seeds[row] + place.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
            ids.append(found)
            np.add.at(counts, row, each)
            places[rows] += lengths

        for row, text in enumerate(texts):
            if not text:
                continue
            # A space goes before every text but the empty one, as the model does.
            for body in _parts(b" " + text):
                rows.append(row)
                bodies.append(body)
                size += len(body)
                if size >= _TEXT_AT_ONCE:
                    draw()
                    rows, bodies, size = [], [], 0
        if bodies:
            draw()
        return np.concatenate(ids), counts


def _parts(text: bytes) -> Iterator[bytes]:
    """A text in pieces of whole units, each not much longer than is cut at once."""
    start = 0
    while start < len(text):
        found = _BREAK.search(text, start + _TEXT_AT_ONCE)
        end = found.start() if found else len(text)
        yield text[start:end]
        start = end


def sampled_pieces(
    key: Column | str, text: Column, model: str, *, alpha: float = 0.2, seed: int = 0
) -> Column:
    """Column of piece ids: one way to cut the UTF-8 bytes ``text``, drawn by ``key``.

    The same key, text, model, alpha and seed always give the same ids.  A null
    or empty text has no ids; what the model has no piece for goes byte by byte.
    """

    @F.arrow_udf("array<int>")
    def cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        sampler = Sampler(model, alpha, seed)
        for keys, texts in batches:
            ids, counts = sampler(keys.to_pylist(), texts.to_pylist())
            offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
            yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))

    return cut(F.col(key).cast("string") if isinstance(key, str) else key.cast("string"), text)


def _text_of(table: list[bytes], ids: np.ndarray) -> bytes:
    parts = (ids[i : i + _IDS_AT_ONCE].tolist() for i in range(0, len(ids), _IDS_AT_ONCE))
    return b"".join([b"".join(map(table.__getitem__, part)) for part in parts])[1:]


def decoded(ids: Column, model: str) -> Column:
    """The bytes that piece ids stand for: exactly the text that was cut."""

    @F.arrow_udf("binary")
    def joined(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = pieces(model, 0.2).bytes
        for lists in batches:
            values, ends = _flat(lists)
            yield pa.array([_text_of(table, values[a:b]) for a, b in ends], pa.binary())

    return joined(ids)


def round_trip(
    key: str, text: Column, model: str, *, alpha: float = 0.2, seed: int = 0, keep_ids: bool = True
) -> Column:
    """What ``sampled_pieces``, ``digest`` and ``decoded`` give, without moving ids between tasks' workers.

    A struct of piece_ids (null unless ``keep_ids``), n_pieces, ids_crc32 and
    lossless: whether the ids decode to exactly the bytes of the text, null as empty.
    """

    @F.arrow_udf("struct<piece_ids: array<int>, n_pieces: bigint, ids_crc32: bigint, lossless: boolean>")
    def checked(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        sampler = Sampler(model, alpha, seed)
        table = sampler.lattices.table.bytes
        for keys, texts in batches:
            bodies = texts.to_pylist()
            ids, counts = sampler(keys.to_pylist(), bodies)
            ends = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
            lists = [ids[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            yield pa.StructArray.from_arrays(
                [
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(ids)) if keep_ids else pa.nulls(len(keys), pa.list_(pa.int32())),
                    pa.array(counts),
                    pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in lists], pa.int64()),
                    pa.array([_text_of(table, x) == (t or b"") for x, t in zip(lists, bodies, strict=True)], pa.bool_()),
                ],
                ["piece_ids", "n_pieces", "ids_crc32", "lossless"],
            )

    return checked(F.col(key).cast("string"), text)


def digest(ids: Column) -> Column:
    """Number of ids and crc32 of them as little-endian 32-bit integers."""

    @F.arrow_udf("struct<n_pieces: bigint, ids_crc32: bigint>")
    def summed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for lists in batches:
            values, ends = _flat(lists)
            values = values.astype("<u4")
            yield pa.StructArray.from_arrays(
                [
                    pa.array([b - a for a, b in ends], pa.int64()),
                    pa.array([zlib.crc32(values[a:b].tobytes()) for a, b in ends], pa.int64()),
                ],
                ["n_pieces", "ids_crc32"],
            )

    return summed(ids)


def _flat(lists: pa.ListArray) -> tuple[np.ndarray, list[tuple[int, int]]]:
    offsets = lists.offsets.to_numpy()
    values = lists.values.to_numpy(zero_copy_only=False)
    return values, list(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True))


def segmented(docs: DataFrame, model: str, **settings) -> DataFrame:
    """``docs`` with ``piece_ids``; see ``sampled_pieces``.  Keys are doc_ids."""
    return docs.withColumn("piece_ids", sampled_pieces("doc_id", octets("text"), model, **settings))
