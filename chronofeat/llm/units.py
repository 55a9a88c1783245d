"""Cutting texts for tokenizers whose pieces never reach across a space before a word."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Longer units are encoded each time; caches hold short ones only.
LONGEST = 64
#: Entries after which a worker's cache starts again.
ENTRIES = 800_000

_ODD_SPACE = re.compile(r" (?:\s|\Z)")
_BEFORE_WORD = re.compile(r"(?= \S)")


class Cache:
    """Codes by key, bounded: it starts again when full, and long keys are not kept."""

    def __init__(self, compute: Callable[[list[str]], Iterable[bytes]]):
        self.compute, self.known = compute, {}

    def codes(self, keys: list[str]) -> list[bytes]:
        """The codes of all keys; those that are new are computed at once."""
        found = list(map(self.known.get, keys))
        new = list(dict.fromkeys(k for k, code in zip(keys, found, strict=True) if code is None))
        if not new:
            return found
        if len(self.known) + len(new) > ENTRIES:
            self.known = {k: code for k, code in zip(keys, found, strict=True) if code is not None}
        self.known.update(zip(new, self.compute(new), strict=True))
        found = list(map(self.known.__getitem__, keys))
        for key in new:
            if len(key) > LONGEST:
                del self.known[key]
        return found


def cut(text: str) -> list[str]:
    """Units of a text: each ends before a space that a word follows, or at the text's end.

    The pre-tokenizer's pattern always starts a new piece at such a space, so the ids of a text are
    those of its units, one after another. The space that starts a unit is left out, so that no unit
    starts with white space; the first one, which lacks that space, is marked by a space instead.
    """
    if _ODD_SPACE.search(text):
        first, *rest = _BEFORE_WORD.split(text)
        starts_so = first.startswith(" ") and first[1:2].strip()
        return [first[1:] if starts_so else " " + first, *[u[1:] for u in rest]]
    units = text.split(" ")
    units[0] = " " + units[0]
    return units


def whole(unit: str) -> str:
    """The text of a unit of `cut`."""
    return unit[1:] if unit[:1] == " " else " " + unit


class Units:
    """Encodes texts unit by unit, with a bounded cache per Python worker.

    `encode` gives the ids of each text as little-endian unsigned 32-bit numbers.
    """

    def __init__(self, encode: Callable[[list[str]], Iterable[bytes]]):
        self.cache = Cache(lambda units: encode([whole(u) for u in units]))

    def ids(self, texts: list[str]) -> list[bytes]:
        units, ends = [], [0]
        for text in texts:
            units += cut(text)
            ends.append(len(units))
        codes = self.cache.codes(units)
        return [b"".join(codes[a:b]) for a, b in zip(ends, ends[1:], strict=False)]


def id_lists(codes: list[bytes]) -> pa.ListArray:
    """Arrow lists of 32-bit ids from their bytes."""
    ends = np.cumsum([0, *(len(c) // 4 for c in codes)])
    values = pa.array(np.frombuffer(b"".join(codes), "<i4"))
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), values)


def slices(
    batch: pa.RecordBatch, text: int = 1, rows: int = 256, most: int = 1 << 23
) -> Iterator[pa.RecordBatch]:
    """Short batches: up to `rows` rows and, unless a single row has more, `most` bytes of text.

    What a task holds beside its input stays small, and lists of ids stay far below the 2 ** 31
    entries that an Arrow list array can address.
    """
    column = batch.column(text)
    lengths = pc.list_value_length if pa.types.is_list(column.type) else pc.binary_length
    sizes = lengths(column).fill_null(0)
    at = held = 0
    for row, size in enumerate(sizes.to_pylist()):
        if row > at and (row - at == rows or held + size > most):
            yield batch.slice(at, row - at)
            at, held = row, 0
        held += size
    if at < batch.num_rows:
        yield batch.slice(at)
