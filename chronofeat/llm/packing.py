"""Bulk-synchronous best-fit packing of tokenised documents."""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronofeat.llm.common import Scratch
from chronofeat.llm.shards import lookup
from chronofeat.llm.units import slices

CAPACITY = 1024
END = 2

#: Fixed value: the pattern that byte-level splitting uses.
BYTE_LEVEL_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)

#: White space in a row from which a text goes to the slower library.
WIDE = 10_000
_WIDE_SPACE = re.compile(rf"\s{{{WIDE}}}")

_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


class Tokenizer:
    """The ids that a byte-level BPE file of the tokenizers library gives; one per Python worker.

    The file's vocabulary and splitting pattern go to the tiktoken library, which takes about a
    quarter of the time. That needs ids in the order of the merges, and merges are what gives every
    longer token; both are checked when the file is opened, and other files are refused. Texts with
    very long runs of white space, on which tiktoken's pattern engine runs out of stack, go to
    the tokenizers library itself. The strings of special tokens in a text are ordinary text.
    """

    _open: dict[str, Tokenizer] = {}

    def __init__(self, path: str):
        import tiktoken

        ranks, pattern = read_byte_level(path)
        self.path, self.slow = path, None
        self.fast = tiktoken.Encoding(
            path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary

    @classmethod
    def open(cls, path: str) -> Tokenizer:
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def ids(self, text: str) -> array:
        if len(text) > WIDE and _WIDE_SPACE.search(text):
            return array("I", self._by_library(text))
        return array("I", self.fast(text))

    def _by_library(self, text: str) -> list[int]:
        if self.slow is None:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one worker per core
            from tokenizers import Tokenizer as Library

            self.slow = Library.from_file(self.path)
            self.slow.encode_special_tokens = True
        return self.slow.encode(text, add_special_tokens=False).ids


def byte_letters() -> dict[str, int]:
    """The letter by which byte-level vocabularies write each byte: itself where it can be seen,
    and the letters from 256 on for the others, in order."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in seen]
    return {chr(b): b for b in seen} | {chr(256 + k): b for k, b in enumerate(hidden)}


def read_byte_level(path: str) -> tuple[dict[bytes, int], str]:
    """Token bytes with their ids, and the pattern, of a byte-level BPE file."""
    with open(path, encoding="utf-8") as lines:
        read = json.load(lines)
    model, splitter = read["model"], read["pre_tokenizer"]
    plain = (
        read["normalizer"] is None
        and splitter["type"] == "ByteLevel"
        and not splitter["add_prefix_space"]
        and splitter.get("use_regex", True)
        and not any(
            model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")
        )
    )
    if model["type"] != "BPE" or not plain:
        raise ValueError(f"{path} is not a plain byte-level BPE file")
    letters = byte_letters()
    special = {t["content"] for t in read["added_tokens"] if t["special"]}
    ranks = {
        bytes(letters[c] for c in token): id
        for token, id in model["vocab"].items()
        if token not in special
    }
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    made = [model["vocab"]["".join(pair)] for pair in pairs]
    if made != sorted(made) or len(made) + 256 != len(ranks):
        raise ValueError(f"{path} has ids in another order than merges")
    return ranks, BYTE_LEVEL_PATTERN


def cut_pieces(total: int, capacity: int) -> Iterator[tuple[int, int]]:
    """(start, length) of a document's pieces: only the first may be shorter than the capacity."""
    start = total % capacity
    if start:
        yield 0, start
    for at in range(start, total, capacity):
        yield at, capacity


def token_pieces(
    docs: DataFrame,
    path: str,
    capacity: int = CAPACITY,
    end: int = END,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Token ids of every text followed by `end`, cut into pieces of at most `capacity` ids.

    Rows: doc_id, piece, start, length, ids_crc32 (of the little-endian unsigned 32-bit ids), and
    `ids` on request. Null texts count as empty, which have one id. Null and repeated ids are kept;
    an empty table gives no rows. Only the two named columns are read, so further ones may have any
    name.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = Tokenizer.open(path)
        for batch in batches:
            for rows in slices(batch):
                out = []
                for doc, text in zip(*(c.to_pylist() for c in rows.columns), strict=True):
                    ids = tokenizer.ids(text)
                    ids.append(end)
                    code = ids.tobytes()
                    for piece, (at, n) in enumerate(cut_pieces(len(code) // 4, capacity)):
                        own = code[4 * at : 4 * (at + n)]
                        row = (doc, piece, at, n, zlib.crc32(own))
                        out.append((*row, array("I", own).tolist()) if with_ids else row)
                columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    if with_ids:
        names, types = [*names, "ids"], [*types, pa.list_(pa.int64())]
    text = F.coalesce(F.col(text_col), F.lit("")).alias("text")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text)
    return rows.mapInArrow(run, _PIECE + (", ids array<long>" if with_ids else ""))


class Plan:
    """Best-fit supersteps over runs of equal documents and equal gaps.

    Documents of one length, and gaps of one size, are interchangeable, so both sorted lists are
    kept as runs (size, first rank, number): at most `capacity` runs of documents, whatever their
    number. A superstep

    - sweeps sizes from large to small: the successor of a document is the smallest gap that holds
      it and that no longer document of this sweep has taken; where more documents than gaps meet,
      ranks decide, and the others look on among larger gaps;
    - then gives every gap that took documents its new size.

    Each gap takes one document per superstep. When no document fits a gap, the longest open as many
    sequences as their tokens need at least, and those over half the capacity one each.

    `placed` has a run per match: (length, first rank, number, first sequence, offset).
    """

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity = capacity
        self.waiting = {size: [0, n] for size, n in counts.items() if n}  # next rank, number
        self.gaps: dict[int, list[list[int]]] = {}  # size: runs of [first sequence, number]
        self.placed: list[tuple[int, int, int, int, int]] = []
        self.sequences = self.supersteps = 0

    def run(self) -> Plan:
        while self.waiting:
            self.supersteps += 1
            if not self._sweep():
                self._open()
        return self

    def _take(self, size: int, most: int) -> tuple[int, int]:
        """Up to `most` of the waiting documents of a length, by rank."""
        state = self.waiting[size]
        first, n = state[0], min(most, state[1])
        state[0], state[1] = first + n, state[1] - n
        if not state[1]:
            del self.waiting[size]
        return first, n

    def _sweep(self) -> bool:
        before = len(self.placed)
        open_: list[tuple[int, list[int]]] = []  # the smallest gap comes last
        left: list[tuple[int, list[int]]] = []
        for size in sorted({*self.waiting, *self.gaps}, reverse=True):
            open_.extend((size, run) for run in reversed(self.gaps.get(size, ())))
            while size in self.waiting and open_:
                gap, run = open_[-1]
                first, n = self._take(size, run[1])
                self.placed.append((size, first, n, run[0], self.capacity - gap))
                if gap > size:
                    left.append((gap - size, [run[0], n]))
                run[0], run[1] = run[0] + n, run[1] - n
                if not run[1]:
                    open_.pop()
        self.gaps = {}
        for gap, run in [*open_, *left]:
            self.gaps.setdefault(gap, []).append(run)
        return len(self.placed) > before

    def _open(self) -> None:
        tokens = sum(size * n for size, (_, n) in self.waiting.items())
        large = sum(n for size, (_, n) in self.waiting.items() if 2 * size > self.capacity)
        need = max(large, -(-tokens // self.capacity))
        for size in sorted(self.waiting, reverse=True):
            if not need:
                break
            first, n = self._take(size, need)
            need -= n
            self.placed.append((size, first, n, self.sequences, 0))
            if size < self.capacity:
                self.gaps.setdefault(self.capacity - size, []).append([self.sequences, n])
            self.sequences += n


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """`pieces` (with doc_id, piece, start, length) plus sequence_id and offset.

    Pieces are range-sorted by length, ties by their place in the input, and numbered within their length from the sizes
    of the sorted parts. The plan's runs then tell each rank its sequence and place. Rows of equal
    length may be exchanged, so ties and repeated rows need no rule. No rows give no sequences.
    """
    spark = pieces.sparkSession
    scratch = Scratch(spark, "packing")
    pieces = scratch.keep(pieces, "pieces")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = pieces.withColumn("_row", F.monotonically_increasing_id())
    sorted_ = placed.repartitionByRange(parts, "length", "_row").sortWithinPartitions("length")
    sorted_ = sorted_.withColumn("_row", F.monotonically_increasing_id())
    sorted_ = scratch.keep(sorted_, "sorted")
    scratch.drop(pieces)
    part = F.shiftright("_row", 33)
    sizes = {r[0]: r[1] for r in sorted_.groupBy(part).count().collect()}  # one row per task
    counts = {r[0]: r[1] for r in sorted_.groupBy("length").count().collect()}  # <= capacity rows
    before, total = [], 0
    for k in range(max(sizes, default=-1) + 1):
        before.append(total)
        total += sizes.get(k, 0)
    shorter, total = [0] * (capacity + 1), 0
    for length in range(capacity + 1):
        shorter[length] = total
        total += counts.get(length, 0)
    rank = lookup(before, part) + F.col("_row").bitwiseAND(F.lit(2**33 - 1))
    ranked = sorted_.withColumn("_rank", rank - lookup(shorter, F.col("length")))
    plan = Plan(counts, capacity).run()
    runs = spark.createDataFrame(
        plan.placed, "length long, _first long, _number long, _sequence long, offset long"
    )
    runs = F.broadcast(runs)  # some runs per length and superstep, however many the documents
    inside = (F.col("_rank") >= F.col("_first")) & (
        F.col("_rank") < F.col("_first") + F.col("_number")
    )
    placed = ranked.join(runs, "length").where(inside)
    return placed.select(
        *pieces.columns,
        (F.col("_sequence") + F.col("_rank") - F.col("_first")).alias("sequence_id"),
        "offset",
    )


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, **options) -> DataFrame:
    """`token_pieces` packed into sequences of at most `capacity` ids."""
    return pack(token_pieces(docs, path, capacity, **options), capacity)
