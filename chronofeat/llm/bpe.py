"""Byte-level BPE encoding by a segment tree, and decoding."""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronofeat.llm.units import LONGEST, Units, id_lists, slices

_NONE = 1 << 62
#: Pieces merged side by side.
BLOCK = 8192


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks, which are also their ids."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def encode_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Merge the pair of lowest rank, the leftmost of equal ones, until no pair has a rank.

    A leaf of the tree stands for the byte at which a live token starts. It holds the rank of that
    token joined with the next one, together with its place; a node holds the smaller of its
    children, so the root is the next merge. A merge changes the leaves of the token, of its left
    neighbour and of the right one, which ends; each change climbs until a node keeps its value.
    """
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    size = 1 << (n - 1).bit_length()
    find = ranks.get
    # Arrays of numbers: a piece of tens of megabytes takes 16 bytes a leaf and no objects.
    end = array("q", range(1, n + 1))
    before = array("q", range(-1, n - 1))
    tree = array("q", [_NONE]) * (2 * size)
    for i in range(n - 1):
        rank = find(piece[i : i + 2])
        if rank is not None:
            tree[size + i] = rank * size + i
    for k in range(size - 1, 0, -1):
        a, b = tree[2 * k], tree[2 * k + 1]
        tree[k] = a if a < b else b
    while (best := tree[1]) != _NONE:
        at = best & (size - 1)
        gone = end[at]
        stop = end[at] = end[gone]
        changes = [(gone, _NONE)]
        if stop < n:
            before[stop] = at
            rank = find(piece[at : end[stop]])
            changes.append((at, _NONE if rank is None else rank * size + at))
        else:
            changes.append((at, _NONE))
        left = before[at]
        if left >= 0:
            rank = find(piece[left:stop])
            changes.append((left, _NONE if rank is None else rank * size + left))
        for leaf, value in changes:
            k = size + leaf
            tree[k] = value
            while k > 1:
                other = tree[k ^ 1]
                if other < value:
                    value = other
                k >>= 1
                if tree[k] == value:
                    break
                tree[k] = value
    ids, at = [], 0
    while at < n:
        ids.append(ranks[piece[at : end[at]]])
        at = end[at]
    return ids


class PairRanks:
    """Ranks of joined tokens by the two ids, for whole arrays at once."""

    def __init__(self, ranks: dict[bytes, int]):
        pairs = {
            (ranks[token[:k]] << 32) | ranks[token[k:]]: rank
            for token, rank in ranks.items()
            for k in range(1, len(token))
            if token[:k] in ranks and token[k:] in ranks
        }
        keys = np.fromiter(pairs.keys(), np.int64, len(pairs))
        order = np.argsort(keys)
        self.keys = keys[order]
        self.ranks = np.fromiter(pairs.values(), np.int64, len(pairs))[order]

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank, or -1 where the two do not join."""
        wanted = (left << 32) | right
        found = np.searchsorted(self.keys, wanted)
        found[found == len(self.keys)] = 0
        return np.where(self.keys[found] == wanted, self.ranks[found], -1)


def encode_block(
    pieces: list[bytes], size: int, byte_ids: np.ndarray, join: PairRanks
) -> list[bytes]:
    """`encode_piece` for many pieces of at most `size` (a power of two) bytes, step by step.

    All trees are rows of one array. In a step every piece that has a merge left makes its next one.
    """
    count, shift = len(pieces), size.bit_length() - 1
    lengths = np.fromiter(map(len, pieces), np.int64, count)
    padded = b"".join(p.ljust(size, b"\0") for p in pieces)
    ids = byte_ids[np.frombuffer(padded, np.uint8).reshape(count, size)]
    place = np.arange(size)
    alive = place < lengths[:, None]
    after = np.broadcast_to(place + 1, (count, size)).copy()
    before = np.broadcast_to(place - 1, (count, size)).copy()
    tree = np.full((count, 2 * size), _NONE, np.int64)
    rank = join(ids[:, :-1], ids[:, 1:])
    tree[:, size:-1] = np.where((rank >= 0) & alive[:, 1:], (rank << shift) | place[:-1], _NONE)
    level = size // 2
    while level:
        below = tree[:, 2 * level : 4 * level]
        tree[:, level : 2 * level] = np.minimum(below[:, ::2], below[:, 1::2])
        level //= 2
    rows = np.arange(count)
    while True:
        best = tree[rows, 1]
        open_ = best != _NONE
        rows, best = rows[open_], best[open_]
        if not len(rows):
            break
        at, rank = best & (size - 1), best >> shift
        gone = after[rows, at]
        stop = after[rows, gone]
        ids[rows, at], alive[rows, gone], after[rows, at] = rank, False, stop
        more = stop < lengths[rows]
        before[rows[more], stop[more]] = at[more]
        own = np.full(len(rows), _NONE, np.int64)
        joined = join(rank[more], ids[rows[more], stop[more]])
        own[more] = np.where(joined >= 0, (joined << shift) | at[more], _NONE)
        left = before[rows, at]
        some = left >= 0
        joined = join(ids[rows[some], left[some]], rank[some])
        tree[rows, size + gone] = _NONE
        tree[rows, size + at] = own
        tree[rows[some], size + left[some]] = np.where(
            joined >= 0, (joined << shift) | left[some], _NONE
        )
        left = np.where(some, left, at)
        for up in range(1, shift + 1):
            for leaf in (gone, at, left):
                node = (size + leaf) >> up
                tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])
    flat = ids[alive].astype("<i4").tobytes()
    ends = np.cumsum(alive.sum(axis=1) * 4).tolist()
    return [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]


class Codec:
    """Encoder and decoder of one rank file; one per Python worker."""

    _open: dict[tuple, Codec] = {}

    def __init__(self, path: str, pattern: str):
        self.ranks = read_ranks(path)
        self.tokens = {i: t for t, i in self.ranks.items()}
        self.join = PairRanks(self.ranks)
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)])
        self.split = regex.compile(pattern).findall
        self.letters = all(self.split(t) == [t] for t in ("ab", " ab", "äß", " Ж日"))
        self.units = Units(self._encode_units)

    @classmethod
    def open(cls, path: str, pattern: str) -> Codec:
        if (path, pattern) not in cls._open:
            cls._open[path, pattern] = cls(path, pattern)
        return cls._open[path, pattern]

    def _encode_units(self, units: list[str]) -> list[bytes]:
        """A unit of a space and letters, as most are, is one match of the pattern of its own."""
        pieces = [
            [u] if (u[1:] if u[:1] == " " else u).isalpha() and self.letters else self.split(u)
            for u in units
        ]
        new = list(dict.fromkeys(chain.from_iterable(pieces)))
        code = dict(zip(new, self._encode_pieces(new), strict=True)).__getitem__
        return [code(own[0]) if len(own) == 1 else b"".join(map(code, own)) for own in pieces]

    def _encode_pieces(self, texts: list[str]) -> list[bytes]:
        pieces = [t.encode() for t in texts]
        out: list[bytes | None] = [None] * len(pieces)
        by_size: dict[int, list[int]] = {}
        for k, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                out[k] = whole.to_bytes(4, "little")
            elif len(piece) > LONGEST:
                out[k] = np.array(encode_piece(piece, self.ranks), "<i4").tobytes()
            else:
                by_size.setdefault(1 << (len(piece) - 1).bit_length(), []).append(k)
        for size, places in by_size.items():
            for low in range(0, len(places), BLOCK):
                some = places[low : low + BLOCK]
                block = [pieces[k] for k in some]
                codes = encode_block(block, size, self.byte_ids, self.join)
                for k, code in zip(some, codes, strict=True):
                    out[k] = code
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        return self.units.ids(texts)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def decode_all(self, lists: pa.ListArray) -> pa.Array:
        """The bytes of each list of ids; null lists count as empty."""
        flat = np.asarray(lists.values)
        ends = np.asarray(lists.offsets)
        texts = [
            b"" if null else self.decode(flat[a:b].tolist())
            for a, b, null in zip(ends, ends[1:], lists.is_null().to_pylist(), strict=False)
        ]
        return pa.array(texts, pa.binary())


def encode_texts(
    docs: DataFrame,
    path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_decoded: bool = False,
) -> DataFrame:
    """(id, ids): the token ids of every whole text, without special tokens.

    `pattern` cuts a text, and each match is merged by the ranks in the file at `path`, which is
    read once by each Python worker. `with_decoded` adds `decoded`, the bytes that the ids stand
    for, as `decode_ids` does, without sending the ids to another worker for it.

    Null texts count as empty; empty texts have no ids. Every row gives one row, with null or
    repeated ids too; an empty table gives none. Only the two named columns are read, so further
    ones may have any name. Rows are neither joined nor shuffled.
    """
    names = [id_col, "ids", *["decoded"] * with_decoded]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.open(path, pattern)
        for batch in batches:
            for rows in slices(batch):
                ids = id_lists(codec.encode(rows.column(1).to_pylist()))
                decoded = [codec.decode_all(ids)] if with_decoded else []
                yield pa.RecordBatch.from_arrays([rows.column(0), ids, *decoded], names)

    rows = docs.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    more = ", decoded binary" if with_decoded else ""
    return rows.mapInArrow(run, f"{id_col} {kind}, ids array<int>{more}")


def decode_ids(encoded: DataFrame, path: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """(id, ids, decoded): the bytes that `ids` stand for. Null ids count as none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.open(path, pattern)
        for batch in batches:
            for rows in slices(batch):
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), codec.decode_all(rows.column(1))],
                    [id_col, "ids", "decoded"],
                )

    kind = encoded.schema[id_col].dataType.simpleString()
    return encoded.select(id_col, "ids").mapInArrow(
        run, f"{id_col} {kind}, ids array<int>, decoded binary"
    )
