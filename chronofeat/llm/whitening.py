"""Embedding whitening over distinct vectors, weighted by one or by their multiplicity."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronofeat.llm.common import Scratch, attach

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 16
#: Scaled entries end here, so that they are exact as doubles.
LIMIT = 2**52
#: Components with less than this part of the variance are rounding noise.
NOISE = 1e-13


def finite_vectors(vectors: DataFrame, vec_col: str) -> DataFrame:
    """The rows whose vector is not null and holds neither nulls nor infinite or missing numbers."""
    good = F.forall(
        vec_col, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    )
    return vectors.where(F.col(vec_col).isNotNull() & F.coalesce(good, F.lit(False)))


def scaled(vec: Column, scale: int, limit: int = LIMIT) -> Column:
    """floor(scale * c) of each entry, as long; values past `limit` end there."""
    edge = F.lit(float(limit))
    return F.transform(
        vec, lambda c: F.floor(F.greatest(-edge, F.least(edge, c.cast("double") * scale)))
    )


def matrix(column: pa.Array, width: int, kind: type) -> np.ndarray:
    """A list column as a matrix; shorter lists end in zeros."""
    offsets = np.asarray(column.offsets)
    lengths = np.diff(offsets)
    flat = np.asarray(column.values)[offsets[0] : offsets[-1]].astype(kind, copy=False)
    if len(lengths) == 0 or (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), kind)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


Blocks = Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray]]


def exact_sums(rows: DataFrame, read: Blocks, width: int) -> tuple[int, list[int]]:
    """Total weight and weighted sum of each dimension, in exact integers.

    Each task adds up its own batches; the tasks' sums are added by dimension in a shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, sums = 0, [0] * width
        for batch in batches:
            x, w = read(batch)
            total += int(w.sum())
            if float(np.abs(x).max(initial=0)) * float(w.sum()) < 2**62:
                new = (x * w[:, None]).sum(axis=0).tolist()
            else:
                new = (x.astype(object) * w.astype(object)[:, None]).sum(axis=0)
            sums = [a + int(b) for a, b in zip(sums, new, strict=True)] if len(x) else sums
        dims = pa.array(range(-1, width), pa.int32())
        yield pa.RecordBatch.from_arrays([dims, pa.array(list(map(str, [total, *sums])))], names)

    names = ["dim", "sum"]
    parts = rows.mapInArrow(run, "dim int, sum string")
    added = parts.groupBy("dim").agg(F.sum(F.col("sum").cast("decimal(38,0)")).alias("sum"))
    by = {r["dim"]: int(r["sum"]) for r in added.collect()}  # width + 1 rows
    return by.get(-1, 0), [by.get(d, 0) for d in range(width)]


def centred_gemm(rows: DataFrame, read: Blocks, width: int) -> np.ndarray:
    """Sum of w * v v^T over all rows, where `read` gives centred rows v and weights w.

    Each task multiplies its batches into one matrix; entries are added by place in a shuffle, so
    the driver gets one matrix of width * width numbers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                v, w = read(batch.slice(at, 4096))
                total += v.T @ (v * w[:, None])
        places = pa.array(np.arange(width * width, dtype=np.int64))
        yield pa.RecordBatch.from_arrays([places, pa.array(total.ravel())], ["place", "value"])

    parts = rows.mapInArrow(run, "place long, value double")
    out = np.zeros(width * width)
    for r in parts.groupBy("place").agg(F.sum("value").alias("value")).collect():
        out[r["place"]] = r["value"]
    return out.reshape(width, width)


@dataclass(frozen=True)
class Whitening:
    """A fitted transform: exact sums of the fit list, eigenvalues by size, their unit vectors."""

    total: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray

    def means(self) -> tuple[np.ndarray, np.ndarray]:
        """The means as whole parts and remainders, so that centring loses no digits."""
        n = max(self.total, 1)
        whole = [s // n for s in self.sums]
        rest = [(s - n * m) / n for s, m in zip(self.sums, whole, strict=True)]
        return np.array(whole, np.int64), np.array(rest)

    def projection(self, components: int) -> np.ndarray:
        """Columns that centre vectors are multiplied with; those without variance are missing."""
        trace = self.values.sum()
        kept = self.values[:components]
        good = kept > NOISE * trace
        scale = np.where(good, 1 / np.sqrt(np.where(good, kept, 1)), np.nan)
        return self.vectors[:, :components] * scale


def _centred(read: Blocks, whole: np.ndarray, rest: np.ndarray) -> Blocks:
    def run(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        x, w = read(batch)
        return (x - whole) - rest, w.astype(float)

    return run


def fit(distinct: DataFrame, weights: str, width: int) -> Whitening:
    """Mean and covariance of `x` over distinct vectors; `weights` is "one" or "counts"."""

    def read(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        x = matrix(batch.column(0), width, np.int64)
        w = np.asarray(batch.column(1)) if weights == "counts" else np.ones(len(x), np.int64)
        return x, w

    rows = distinct.select("x", "copies")
    total, sums = exact_sums(rows, read, width)
    fitted = Whitening(total, sums, np.zeros(width), np.eye(width))
    products = centred_gemm(rows, _centred(read, *fitted.means()), width)
    values, vectors = np.linalg.eigh(products / max(total, 1))
    order = np.argsort(-values, kind="stable")
    return Whitening(total, sums, np.maximum(values[order], 0), vectors[:, order])


def _deviations(x: np.ndarray, whole: np.ndarray, fitted: Whitening) -> list[int | None]:
    """Sum over dimensions of (n * x - S) ** 2, exact; None where it passes the longs."""
    n = fitted.total
    rest = [s - n * int(m) for s, m in zip(fitted.sums, whole, strict=True)]  # 0 <= rest < n
    near = x - whole
    most = (float(np.abs(near).max(initial=0)) + 1) * n
    if most * most * max(x.shape[1], 1) < 2**62:
        return ((n * near - np.array(rest, np.int64)) ** 2).sum(axis=1).tolist()
    found = [
        sum((n * int(a) - r) ** 2 for a, r in zip(row, rest, strict=True)) for row in near.tolist()
    ]
    return [d if d < 2**63 else None for d in found]


def whiten(
    vectors: DataFrame,
    components: int = COMPONENTS,
    weights: str = "one",
    scale: int = SCALE,
    shift: int = SHIFT,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
) -> DataFrame:
    """One row per usable vector: vec_id, n, deviation, whitened (array), explained (array),
    identity_error.

    Entries become whole numbers x. Identical x vectors are one row of a table with their number;
    mean and covariance are fitted over it with the weight `one` or the `counts`, every distinct
    vector is projected once, and results are joined back to all rows.

    Rows with null vectors, or null or infinite entries, give no row. Vectors shorter than the
    longest one end in zeros. Repeated rows and null ids are kept. Entries past 2 ** 52 after
    scaling end there; a deviation past the longs is null. Components without variance have a null
    value. Empty tables give no rows; only the two named columns are read.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "whitening")
    usable = finite_vectors(vectors.select(id_col, vec_col), vec_col)
    rows = usable.select(
        F.col(id_col).alias("vec_id"),
        F.transform(scaled(F.col(vec_col), scale), lambda x: x + F.lit(shift)).alias("x"),
    )
    width = usable.agg(F.max(F.size(vec_col))).first()[0] or 0
    if width:
        pad = F.array_repeat(F.lit(shift).cast("long"), F.lit(width) - F.size("x"))
        rows = rows.withColumn("x", F.when(F.size("x") < width, F.concat("x", pad)).otherwise(F.col("x")))
    distinct = scratch.keep(rows.groupBy("x").agg(F.count(F.lit(1)).alias("copies")), "distinct")
    fitted = fit(distinct, weights, width)
    components = min(components, width)
    whole, rest = fitted.means()
    across = fitted.projection(components)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                x = matrix(part.column(0), width, np.int64)
                new = ((x - whole) - rest) @ across
                ends = np.arange(len(x) + 1, dtype=np.int32) * components
                flat = pa.array(new.ravel(), mask=np.isnan(new.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array(_deviations(x, whole, fitted), pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends), flat),
                    ],
                    ["x", "copies", "deviation", "whitened"],
                )

    schema = "x array<long>, copies long, deviation long, whitened array<double>"
    white = scratch.keep(distinct.mapInArrow(project, schema), "white")
    live = [k for k in range(components) if not math.isnan(across[:, k].sum())]

    def read(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        own = matrix(batch.column(0), components, float)
        w = np.asarray(batch.column(1)) if weights == "counts" else np.ones(len(own))
        return own[:, live], w.astype(float)

    error = 0.0
    if live and fitted.total:
        # The projected rows are centred already: their mean is that of x.
        found = centred_gemm(white.select("whitened", "copies"), read, len(live)) / fitted.total
        error = float(np.abs(found - np.eye(len(live))).max())
    trace = float(fitted.values.sum())
    shares = [float(v) / trace if trace else 0.0 for v in fitted.values[:components]]
    done = white.withColumn("_copies", F.col("copies")).drop("copies")
    joined = attach(rows, done, "x", "_copies")
    return joined.select(
        F.col("vec_id").alias(id_col),
        F.lit(fitted.total).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.array(*[F.lit(s) for s in shares]).cast("array<double>").alias("explained"),
        F.lit(error).alias("identity_error"),
    )
