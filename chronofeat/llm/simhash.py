"""Near-duplicate documents by SimHash fingerprints, compared exactly in tiles."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronofeat.llm.common import Scratch, attach, restored, shielded
from chronofeat.llm.components import components

SHINGLE = 4
RADIUS = 4
SEED = 42
#: Bits of the parts whose population counts name a cell of tiles.
PARTS = ((0, 22), (22, 21), (43, 21))
#: Fingerprints per tile, about.
TILE = 8192
#: Comparisons made at once in a task.
BLOCK = 2**20

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """Majority of the bits of the XXH64 hashes of all word shingles, as a signed 64-bit number."""
    words = text.encode().translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[:-1]]
    last = ends[min(shingle, len(words)) - 1 :]
    count = len(last)
    votes = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for low in range(0, count, BLOCK // 64):  # very long texts in pieces
        high = min(low + BLOCK // 64, count)
        hashes = np.fromiter(
            (
                digest(joined[a : b - 1], SEED)
                for a, b in zip(starts[low:high], last[low:high], strict=False)
            ),
            "<u8",
            high - low,
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(votes * 2 > count, bitorder="little")
    return int(packed.view("<i8")[0])


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE
) -> DataFrame:
    """(doc_id, text_key, fp) of every row. Null and empty texts have fingerprint 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t, shingle) for t in batch.column(2).to_pylist()]
            fps = pa.array(prints, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), fps], ["doc_id", "text_key", "fp"]
            )

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text
    )
    return rows.mapInArrow(run, "doc_id long, text_key long, fp long")


def _cell(fp: Column) -> Column:
    counts = [
        F.bit_count(F.shiftright(fp, low).bitwiseAND(F.lit(2**width - 1))) for low, width in PARTS
    ]
    return counts[0] * 4096 + counts[1] * 64 + counts[2]


def _steps(radius: int) -> list[int]:
    """Cell differences within the radius, one of each pair of opposite ones.

    Two fingerprints differ in at least as many bits as the population counts of their parts do
    together. A count has at most 23 values, so a step out of range meets no cell.
    """
    span = range(-radius, radius + 1)
    near = [d for d in product(span, span, span) if sum(map(abs, d)) <= radius and d >= (0, 0, 0)]
    return [a * 4096 + b * 64 + c for a, b, c in near]


def compare(a: np.ndarray, b: np.ndarray, radius: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links between the fingerprints of two tiles, enough of them to connect what is linked."""
    found = []
    rows = max(1, BLOCK // len(b))
    for low in range(0, len(a), rows):
        part = a[low : low + rows]
        near = np.bitwise_count(part[:, None] ^ b[None, :]) <= radius
        x, y = np.nonzero(near)
        if len(x) > 4 * (len(part) + len(b)):
            found.extend(_forest(part, b, x, y))
        elif len(x):
            found.append((part[x], b[y]))
    return found


def _forest(a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray) -> list[tuple]:
    """Stars that connect what the links (a[x], b[y]) connect."""
    of_b = np.arange(len(b))
    while True:
        of_a = np.full(len(a), len(b))
        np.minimum.at(of_a, x, of_b[y])
        new = of_b.copy()
        np.minimum.at(new, y, of_a[x])
        if (new == of_b).all():
            break
        of_b = new
    linked_a, linked_b = np.unique(x), np.unique(y)
    return [(a[linked_a], b[of_a[linked_a]]), (b[of_b[linked_b]], b[linked_b])]


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): links that connect all distinct fingerprints of `fps` within `radius` bits.

    Fingerprints lie in cells by the population counts of three parts of their bits; a cell is cut
    into tiles by a hash. Tile pairs whose counts differ by more than the radius never meet. All
    others are compared whole with exclusive-or and bit counts, each pair in one row of a join. The
    join is by the tile and not by its cell, so the pairs of the fullest cell are spread.
    """
    spark = fps.sparkSession
    scratch = Scratch(spark, "simhash")
    placed = fps.withColumn("cell", _cell(F.col("fp")))
    cells = placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / TILE).alias("cuts"))
    cells = scratch.keep(cells, "cells")  # at most 23 * 22 * 22 rows
    cut = F.pmod(F.xxhash64("fp"), F.col("cuts"))
    tiles = placed.join(F.broadcast(cells), "cell").groupBy("cell", cut.alias("cut"))
    tiles = scratch.keep(tiles.agg(F.collect_list("fp").alias("fps")), "tiles")
    step = F.explode(F.array(*map(F.lit, _steps(radius)))).alias("step")
    left = tiles.select(F.col("cell").alias("own"), F.col("cut").alias("own_cut"), "fps", step)
    left = left.withColumn("cell", F.col("own") + F.col("step")).withColumnRenamed("fps", "a")
    cuts = F.broadcast(cells.select("cell", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("cut")))
    left = left.join(cuts, "cell")
    left = left.where((F.col("own") != F.col("cell")) | (F.col("own_cut") <= F.col("cut")))
    pairs = left.join(tiles.withColumnRenamed("fps", "b"), ["cell", "cut"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for a, b in zip(batch.column(0), batch.column(1), strict=True):
                a = a.values.to_numpy(zero_copy_only=False).view(np.uint64)
                b = b.values.to_numpy(zero_copy_only=False).view(np.uint64)
                found.extend(compare(a, b, radius))
            if found:
                x, y = (np.concatenate(side).view(np.int64) for side in zip(*found, strict=True))
                other = x != y
                yield pa.RecordBatch.from_arrays([pa.array(x[other]), pa.array(y[other])], ["a", "b"])

    # A row holds two tiles, so few rows make a batch.
    batch_rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual = spark.conf.get(batch_rows)
    spark.conf.set(batch_rows, "64")
    try:
        found = scratch.keep(pairs.select("a", "b").mapInArrow(run, "a long, b long"), "links")
    finally:
        spark.conf.set(batch_rows, usual)
    scratch.drop(cells, tiles)
    return found


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
) -> DataFrame:
    """One row per input row: id, text_key, fp, component_id, kept.

    Fingerprints within `radius` bits are linked; a component is what links reach, and its id is
    its smallest doc_id. Kept is the row of that id, or of several with that id the one with the
    smallest text_key; equal rows are kept together. Null ids come last: their component has a null
    id only if it has no other. Null and empty texts share fingerprint 0, which links like any other.
    Equal fingerprints collapse before they are compared. An empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "near-duplicates")
    rows = scratch.keep(fingerprints(docs, id_col, text_col, shingle), "rows")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key"))
    classes = rows.groupBy("fp").agg(first.alias("first"), F.count(F.lit(1)).alias("rows"))
    classes = scratch.keep(classes, "classes")
    roots = components(links(classes.select("fp"), radius), "a", "b")
    rooted = classes.join(roots, classes["fp"] == roots["node"], "left").select(
        "fp", "first", "rows", F.coalesce("root", "fp").alias("root")
    )
    rooted = scratch.keep(rooted, "rooted")
    groups = rooted.groupBy("root").agg(
        F.min("first").alias("of_group"), F.count(F.lit(1)).alias("classes")
    )
    found = attach(rooted.select("fp", "rows", "root"), groups, "root", "classes")
    judged = attach(rows, found.select("fp", "rows", "of_group"), "fp", "rows")
    kept = F.col("doc_id").eqNullSafe(F.col("of_group.doc_id")) & (
        F.col("text_key") == F.col("of_group.text_key")
    )
    return judged.select(
        F.col("doc_id").alias(id_col),
        "text_key",
        "fp",
        F.col("of_group.doc_id").alias("component_id"),
        kept.alias("kept"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of `docs` that `near_duplicates` keeps, with all their columns; equal rows once."""
    verdict = near_duplicates(docs.select(id_col, text_col), id_col, text_col, **options)
    stay = verdict.where("kept").select(F.col(id_col).alias("_id"), F.col("text_key").alias("_kept_key"))
    docs, own = shielded(docs)
    keyed = docs.withColumn("_key", F.xxhash64(F.coalesce(F.col(own[text_col]), F.lit(""))))
    same_id = keyed[own[id_col]].eqNullSafe(stay["_id"])
    kept = keyed.join(stay, same_id & (keyed["_key"] == stay["_kept_key"]), "left_semi")
    return restored(kept.dropDuplicates([own[id_col], "_key"]), own)
