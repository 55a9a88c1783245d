"""Boosted trees for counts, grown by Spark jobs over features that are binned once.

With margin m and mean u = exp(m), the Poisson loss has the slope u - y and the curvature u, so a leaf
with sums G of y - u and H of u moves by G / H, and a split gains GL^2/HL + GR^2/HR - G^2/H. A level
of a tree needs these sums per (node, feature, bin): each task adds up its rows, an aggregation adds up
the tasks, and the driver, which sees at most nodes x features x bins sums whatever the number of rows,
picks the splits. Missing values have a bin of their own and go to whichever side gains more.

Rows are kept in blocks: bins as bytes, label, held-out flag and margin. The margin is written anew
every few rounds; the trees since then are applied on the fly. Blocks lie in the shared folder, so a
lost executor costs a retry.
"""

from __future__ import annotations

import json
import math
import random
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronofeat.session import new_shared_path
from chronofeat.sources.files import delete

#: Bins per feature besides the one for missing values.
BINS = 63
#: Rounds after which the margins are written.
FOLD = 10
_BLOCK = "bins binary, label binary, held binary, margin binary"
_LOSS = -1


@dataclass
class Tree:
    """Nodes in heap order: the children of node i are 2i + 1 (left) and 2i + 2."""

    feature: list[int]  # -1 for a leaf
    bin: list[int]  # the last bin that goes left
    missing_left: list[bool]
    value: list[float]
    gain: list[float]

    @staticmethod
    def empty(depth: int) -> Tree:
        n = 2 ** (depth + 1) - 1
        return Tree([-1] * n, [0] * n, [False] * n, [0.0] * n, [0.0] * n)

    def nodes(self, bins: np.ndarray) -> np.ndarray:
        """The node at which each row comes to rest."""
        feature, upto = np.array(self.feature), np.array(self.bin)
        missing, at = np.array(self.missing_left), np.zeros(len(bins), np.int64)
        rows = np.arange(len(bins))
        for _ in range(int(math.log2(len(self.feature) + 1)) - 1):
            split = feature[at]
            found = bins[rows, np.maximum(split, 0)]
            left = np.where(found == 0, missing[at], found <= upto[at])
            at = np.where(split >= 0, 2 * at + 2 - left, at)
        return at

    def values(self, bins: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.nodes(bins)]


@dataclass
class CountTrees:
    """A fitted ensemble: one object for all kept trees, which Spark ships to the tasks."""

    inputs: list[str]
    edges: list[list[float]]
    start: float
    rate: float
    trees: list[Tree] = field(default_factory=list)

    def binned(self, values: np.ndarray) -> np.ndarray:
        out = np.zeros(values.shape, np.uint8)
        for j, edges in enumerate(self.edges):
            known = ~np.isnan(values[:, j])
            out[known, j] = np.searchsorted(edges, values[known, j], side="left") + 1
        return out

    def margins(self, bins: np.ndarray, trees: list[Tree]) -> np.ndarray:
        total = np.zeros(len(bins))
        for tree in trees:
            total += self.rate * tree.values(bins)
        return total

    def transform(self, df: DataFrame) -> DataFrame:
        """`df` with `prediction`, the expected count."""
        model = self

        @F.pandas_udf("double")
        def predict(values: pd.DataFrame) -> pd.Series:
            numbers = values.to_numpy(dtype=float, na_value=np.nan)
            return pd.Series(np.exp(model.start + model.margins(model.binned(numbers), model.trees)))

        columns = [F.col(c).cast("double").alias(c) for c in self.inputs]
        return df.withColumn("prediction", predict(F.struct(*columns)))

    def importance(self) -> dict[str, float]:
        """Per input the gain of all splits on it, in the kept trees."""
        total = dict.fromkeys(self.inputs, 0.0)
        for tree in self.trees:
            for feature, gain in zip(tree.feature, tree.gain, strict=True):
                if feature >= 0:
                    total[self.inputs[feature]] += gain
        return total

    def to_json(self) -> str:
        return json.dumps({**vars(self), "trees": [vars(t) for t in self.trees]})

    @staticmethod
    def from_json(text: str) -> CountTrees:
        read = json.loads(text)
        return CountTrees(**{**read, "trees": [Tree(**t) for t in read["trees"]]})


def bin_edges(train: DataFrame, inputs: list[str], bins: int = BINS) -> list[list[float]]:
    """Upper edges of each feature's bins, at quantiles of its known values."""
    shares = [k / bins for k in range(1, bins)]
    found = train.approxQuantile(inputs, shares, 0.001)
    return [sorted(set(edges)) for edges in found]


def fit_count_trees(
    rows: DataFrame,
    inputs: list[str],
    rounds: int,
    rate: float,
    depth: int,
    min_rows: int,
    fraction: float,
    seed: int,
    stalled: Callable[[list], bool],
    first_stop: Callable[[list], int],
) -> tuple[CountTrees, list[float | None]]:
    """An ensemble fitted on `rows` (inputs, label, held_out) and the held-out loss per round.

    Rows that are held out only measure: fitting ends when their losses have `stalled`, and
    `first_stop` tells how many trees are kept. Each tree draws its `fraction` of the features.
    `rows` should be a written table.
    """
    spark = rows.sparkSession
    train = rows.where(~F.col("held_out"))
    mean = train.agg(F.avg("label")).first()[0] or 0.0
    model = CountTrees(list(inputs), bin_edges(train, inputs), math.log(max(mean, 1e-9)), rate)
    blocks = _Blocks(spark, rows, model)
    picker, size = random.Random(seed), max(1, round(fraction * len(inputs)))
    losses: list[float | None] = []
    try:
        for _ in range(rounds):
            chosen = sorted(picker.sample(range(len(inputs)), size))
            tree, loss = _grow(blocks, model, chosen, depth, min_rows)
            if model.trees:
                losses.append(loss)
                if stalled(losses):
                    break
            model.trees.append(tree)
            if len(model.trees) - blocks.folded >= FOLD:
                blocks.fold(model)
        else:
            losses.append(blocks.sums(model, None, [], {})[1])
    finally:
        delete(spark, blocks.path)
    kept = model.trees[: first_stop(losses)]
    return CountTrees(model.inputs, model.edges, model.start, rate, kept), losses


class _Blocks:
    def __init__(self, spark: SparkSession, rows: DataFrame, model: CountTrees):
        self.spark, self.folded = spark, 0
        columns = [F.col(c).cast("double") for c in model.inputs]

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                *values, label, held = (
                    c.to_numpy(zero_copy_only=False) for c in batch.columns
                )
                bins = model.binned(np.column_stack([v.astype(float) for v in values]))
                margin = np.full(len(label), model.start)
                yield _record(bins, label.astype(float), held.astype(np.uint8), margin)

        flagged = [F.col("label").cast("double"), F.coalesce("held_out", F.lit(False)).cast("int")]
        self._store(rows.select(*columns, *flagged).mapInArrow(pack, _BLOCK))

    def _store(self, blocks: DataFrame) -> None:
        self.path = new_shared_path(self.spark, "boosting")
        blocks.write.parquet(self.path)
        self.table = self.spark.read.schema(_BLOCK).parquet(self.path)

    def fold(self, model: CountTrees) -> None:
        """Write the margins with all trees so far."""
        recent, old = model.trees[self.folded :], self.path

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for bins, label, held, margin in _opened(batches, len(model.inputs)):
                yield _record(bins, label, held, margin + model.margins(bins, recent))

        self._store(self.table.mapInArrow(run, _BLOCK))
        delete(self.spark, old)
        self.folded = len(model.trees)

    def sums(
        self, model: CountTrees, tree: Tree | None, chosen: list[int], slots: dict[int, int]
    ) -> tuple[np.ndarray, float | None]:
        """Per (slot, chosen feature, bin) the sums of y - u, of u, and the rows; the held-out loss.

        `slots` numbers the nodes of the growing `tree` that are to be split.
        """
        recent, width, bins_n = model.trees[self.folded :], len(model.inputs), BINS + 2
        shape = (len(slots), len(chosen), bins_n)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((3, *shape))
            loss = rows = 0.0
            place = np.full(len(tree.feature) if tree else 1, -1)
            for node, slot in slots.items():
                place[node] = slot
            for bins, label, held, margin in _opened(batches, width):
                margin = margin + model.margins(bins, recent)
                out = held.astype(bool)
                if tree is None or len(slots) == 1 and 0 in slots:  # once a round
                    loss += float((np.exp(margin[out]) - label[out] * margin[out]).sum())
                    rows += int(out.sum())
                if tree is None:
                    continue
                bins, label, u = bins[~out], label[~out], np.exp(margin[~out])
                slot = place[tree.nodes(bins)]
                own = slot >= 0
                pull = label - u
                total += _histograms(bins[own], slot[own], pull[own], u[own], chosen, shape)
            cells = np.flatnonzero(total[2].ravel())
            flat = total.reshape(3, -1)[:, cells]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.append(cells, _LOSS)),
                    pa.array(np.append(flat[0], loss)),
                    pa.array(np.append(flat[1], rows)),
                    pa.array(np.append(flat[2], 0.0)),
                ],
                ["cell", "g", "h", "n"],
            )

        parts = self.table.mapInArrow(run, "cell long, g double, h double, n double")
        added = parts.groupBy("cell").agg(F.sum("g"), F.sum("h"), F.sum("n")).toArrow()
        cell, *sums = (c.to_numpy() for c in added.columns)
        inner, loss = cell >= 0, None
        if not inner.all() and sums[1][~inner][0]:
            loss = float(sums[0][~inner][0] / sums[1][~inner][0])
        out = np.zeros((3, int(np.prod(shape))))
        out[:, cell[inner]] = [s[inner] for s in sums]
        return out.reshape(3, *shape), loss


def _histograms(
    bins: np.ndarray,
    slot: np.ndarray,
    pull: np.ndarray,
    u: np.ndarray,
    chosen: list[int],
    shape: tuple[int, int, int],
) -> np.ndarray:
    out = np.zeros((3, *shape))
    width = shape[2]
    for k, j in enumerate(chosen):
        key = slot * width + bins[:, j]
        for s, weights in enumerate((pull, u, None)):
            out[s, :, k] = np.bincount(key, weights, shape[0] * width).reshape(shape[0], width)
    return out


def _grow(
    blocks: _Blocks,
    model: CountTrees,
    chosen: list[int],
    depth: int,
    min_rows: int,
) -> tuple[Tree, float | None]:
    """The next tree, and the held-out loss of the trees before it."""
    tree, open_ = Tree.empty(depth), [0]
    before = None
    for level in range(depth):
        slots = {node: k for k, node in enumerate(open_)}
        sums, loss = blocks.sums(model, tree, chosen, slots)
        if level == 0:
            before = loss
        following = []
        for node, slot in slots.items():
            found = best_split(sums[:, slot], min_rows)
            if level == 0:
                g, h = sums[:2, slot, 0].sum(axis=1)
                tree.value[0] = g / h if h > 0 else 0.0
            if found is None:
                continue
            k, upto, missing_left, gain, left, right = found
            tree.feature[node], tree.bin[node] = chosen[k], upto
            tree.missing_left[node], tree.gain[node] = missing_left, gain
            tree.value[2 * node + 1], tree.value[2 * node + 2] = left, right
            following += [2 * node + 1, 2 * node + 2]
        open_ = following
        if not open_:
            break
    return tree, before


def best_split(
    sums: np.ndarray, min_rows: int
) -> tuple[int, int, bool, float, float, float] | None:
    """(feature, last bin on the left, missing go left, gain, left value, right value) of a node.

    `sums` are (3, features, bins): y - u, u, rows; bin 0 holds missing values. None where no split
    leaves `min_rows` on both sides and gains anything.
    """
    whole = sums.sum(axis=2)
    known = sums[:, :, 1:].cumsum(axis=2)[:, :, :-1]
    both = np.stack([known, known + sums[:, :, :1]])  # missing go right, or left
    g, h, n = both[:, 0], both[:, 1], both[:, 2]
    rg, rh, rn = (whole[i][None, :, None] - x for i, x in enumerate((g, h, n)))
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = g**2 / h + rg**2 / rh - (whole[0] ** 2 / whole[1])[None, :, None]
    allowed = (n >= min_rows) & (rn >= min_rows) & (h > 1e-9) & (rh > 1e-9)
    gain = np.where(allowed, gain, -np.inf)
    side, k, b = np.unravel_index(int(gain.argmax()), gain.shape)
    best = float(gain[side, k, b])
    if not best > 1e-12:
        return None
    at = (side, k, b)
    return int(k), int(b) + 1, bool(side), best, float(g[at] / h[at]), float(rg[at] / rh[at])


def _record(
    bins: np.ndarray, label: np.ndarray, held: np.ndarray, margin: np.ndarray
) -> pa.RecordBatch:
    cells = [pa.array([x.tobytes()], pa.binary()) for x in (bins, label, held, margin)]
    return pa.RecordBatch.from_arrays(cells, ["bins", "label", "held", "margin"])


def _opened(
    batches: Iterator[pa.RecordBatch], width: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for bins, label, held, margin in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            yield (
                np.frombuffer(bins, np.uint8).reshape(-1, width),
                np.frombuffer(label),
                np.frombuffer(held, np.uint8),
                np.frombuffer(margin),
            )
