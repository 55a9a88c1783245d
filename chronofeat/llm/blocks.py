"""Exact top-k search by inner product, block at a time, with bounds from the blocks' term maxima."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronofeat.llm.common import Scratch, repeat_rows
from chronofeat.llm.numbering import numbered
from chronofeat.llm.whitening import finite_vectors, matrix, scaled

SCALE = 256
K = 5
#: Rows of a block. A range is a run of blocks that one task searches for one group of queries.
BLOCK = 512
BLOCKS_A_RANGE = 128
QUERIES_A_GROUP = 4096
#: Queries of a block that are scored in one product.
PRODUCT = 256
#: Scaled entries end here.
LIMIT = 2**24

#: Below any score.
_NONE = -(2**62)
_LAST = 2**62

_BLOCK = "block long, n long, nulls long, ids binary, rows binary, high binary, low binary, wide long"


def build_blocks(placed: DataFrame, width: int) -> DataFrame:
    """Blocks of the rows (place, vec_id, x), which lie in runs of consecutive places.

    A block holds its ids, its forward index (`rows`: entries by row, 32 bits each) and per term,
    that is per dimension and sign, its summary: the largest and the smallest entry. Blocks are cut
    where `place` reaches a multiple of `BLOCK` and where the input leaves the order, so one range of
    places may come as two blocks; `block` is the place of the first row. Null ids come last, so
    their number (`nulls`) tells which they are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        following = -1
        for batch in batches:
            places = np.asarray(batch.column(0))
            if held and (places[:1] != following or following % BLOCK == 0):
                yield _block(held, width)
                held = []
            starts = (np.diff(places) != 1) | (places[1:] % BLOCK == 0)
            cuts = [0, *(np.flatnonzero(starts) + 1).tolist(), len(places)]
            for at, end in zip(cuts, cuts[1:], strict=False):
                if at and held:
                    yield _block(held, width)
                    held = []
                if end > at:
                    held.append(batch.slice(at, end - at))
                    following = int(places[end - 1]) + 1
        if held:
            yield _block(held, width)

    return placed.select("place", "vec_id", "x").mapInArrow(run, _BLOCK)


def _block(parts: list[pa.RecordBatch], width: int) -> pa.RecordBatch:
    rows = np.concatenate([matrix(p.column(2), width, np.int32) for p in parts])
    ids = pa.concat_arrays([p.column(1) for p in parts])
    own = [rows.tobytes(), rows.max(axis=0).tobytes(), rows.min(axis=0).tobytes()]
    numbers = [parts[0].column(0)[0].as_py(), len(ids), ids.null_count]
    columns = [pa.array([v], pa.int64()) for v in numbers]
    columns += [pa.array([v]) for v in [np.asarray(ids.fill_null(0)).tobytes(), *own]]
    columns.append(pa.array([int(np.abs(rows).max(initial=0))], pa.int64()))
    names = ["block", "n", "nulls", "ids", "rows", "high", "low", "wide"]
    return pa.RecordBatch.from_arrays(columns, names)


def pack_queries(asked: DataFrame, width: int) -> DataFrame:
    """(place, query_id, x) with the entries as 32-bit numbers in a binary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = pa.array([row.tobytes() for row in matrix(batch.column(2), width, np.int32)], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), x], ["place", "query_id", "x"]
            )

    rows = asked.select("place", "vec_id", "x")
    return rows.mapInArrow(run, "place long, query_id long, x binary")


def _numbers(cells: pd.Series, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(cells), np.int32).reshape(-1, width).astype(np.int64)


class _Best:
    """The k best (score, place) of each query so far, and the limit that a row must reach to enter.

    The limit is the own k-th, or a k-th known from elsewhere if that is better.
    """

    def __init__(self, floors: tuple[np.ndarray, np.ndarray], k: int):
        n = len(floors[0])
        self.floor_scores, self.floor_places = floors
        self.scores = np.full((n, k), _NONE)
        self.places = np.full((n, k), _LAST)

    def limit(self, who: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        score, place = self.scores[who, -1], self.places[who, -1] - 1
        known, at = self.floor_scores[who], self.floor_places[who]
        better = (known > score) | ((known == score) & (at < place))
        return np.where(better, known, score), np.where(better, at, place)

    def may_enter(self, who: np.ndarray, bounds: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Whether a row of a score up to `bounds` and a place from `first` on could still enter."""
        score, place = self.limit(who)
        return (bounds > score) | ((bounds == score) & (first <= place))

    def add(self, who: np.ndarray, scores: np.ndarray, first: int, own: np.ndarray) -> None:
        """Enter `scores` (queries by rows) of a block whose rows have the places from `first` on."""
        k, n = self.scores.shape[1], scores.shape[1]
        score, place = self.limit(who)
        if n > k + 1:  # only what reaches the block's own k-th (one more: a query meets itself)
            score = np.maximum(score, np.partition(scores, n - k - 1, axis=1)[:, n - k - 1])
        q, r = np.nonzero(scores >= score[:, None])
        limit, _ = self.limit(who[q])
        enters = (first + r != own[q]) & ((scores[q, r] > limit) | (first + r <= place[q]))
        q, r = q[enters], r[enters]
        if not len(q):
            return
        touched, group = np.unique(q, return_inverse=True)
        held = who[touched]
        s = np.concatenate([scores[q, r], self.scores[held].ravel()])
        p = np.concatenate([first + r, self.places[held].ravel()])
        g = np.concatenate([group, np.repeat(np.arange(len(touched)), k)])
        order = np.lexsort((p, -s, g))
        g, s, p = g[order], s[order], p[order]
        pick = np.searchsorted(g, np.arange(len(touched)))[:, None] + np.arange(k)
        self.scores[held], self.places[held] = s[pick], p[pick]


def _products(x: np.ndarray, rows: np.ndarray, exact: bool) -> np.ndarray:
    """Integer inner products; doubles give them exactly while no sum passes 2 ** 53."""
    if exact:
        return (x.astype(float) @ rows.T.astype(float, copy=False)).astype(np.int64)
    return x @ rows.T


def _bounds(x: np.ndarray, high: np.ndarray, low: np.ndarray, exact: bool) -> np.ndarray:
    """Per query and block the sum of the terms' maxima: no row of the block scores more."""
    return _products(np.maximum(x, 0), high, exact) + _products(np.minimum(x, 0), low, exact)


def _search(asked: pd.DataFrame, blocks: pd.DataFrame, width: int, k: int) -> _Best:
    """Each query takes the blocks by falling bound until a bound cannot reach its k-th score.

    All queries go on by one block at a time: in round r, those that have not stopped score their
    r-th block, and queries that meet in a block share a product.
    """
    x = _numbers(asked["x"], width)
    if "floor_score" in asked:
        floors = asked["floor_score"].to_numpy(), asked["floor_place"].to_numpy()
    else:
        floors = np.full(len(asked), _NONE), np.full(len(asked), _LAST)
    best = _Best(floors, k)
    blocks = blocks.sort_values("block", ignore_index=True)
    first = blocks["block"].to_numpy()
    most = float(np.abs(x).max(initial=0)) * float(blocks["wide"].max()) * width
    exact = most < 2**53
    bounds = _bounds(x, _numbers(blocks["high"], width), _numbers(blocks["low"], width), exact)
    order = np.argsort(-bounds, axis=1, kind="stable")
    open_ = np.arange(len(x))
    own = asked["place"].to_numpy()
    for r in range(len(blocks)):
        taken = order[open_, r]
        bound = bounds[open_, taken]
        # Later blocks have no higher bounds; those of an equal one could still win by place.
        going = best.may_enter(open_, bound, first[:1])
        open_, taken, bound = open_[going], taken[going], bound[going]
        if not len(open_):
            break
        use = best.may_enter(open_, bound, first[taken])
        who, blocks_of = open_[use], taken[use]
        by = np.argsort(blocks_of, kind="stable")
        who, blocks_of = who[by], blocks_of[by]
        cuts = np.flatnonzero(np.diff(blocks_of)) + 1
        for part in np.split(np.arange(len(who)), cuts):
            if not len(part):
                continue
            b = blocks_of[part[0]]
            rows = np.frombuffer(blocks["rows"][b], np.int32).reshape(-1, width)
            rows = rows.astype(float if exact else np.int64)
            for at in range(0, len(part), PRODUCT):
                some = who[part[at : at + PRODUCT]]
                best.add(some, _products(x[some], rows, exact), first[b], own[some])
    return best


def _found(asked: pd.DataFrame, blocks: pd.DataFrame, best: _Best) -> pd.DataFrame:
    """The rows that entered, with their ids."""
    blocks = blocks.sort_values("block", ignore_index=True)
    q, at = np.nonzero(best.scores > _NONE)
    places, first = best.places[q, at], blocks["block"].to_numpy()
    block = np.searchsorted(first, places, side="right") - 1
    row = places - first[block]
    ids = [np.frombuffer(cell, np.int64) for cell in blocks["ids"]]
    found = np.fromiter((ids[b][r] for b, r in zip(block, row, strict=True)), np.int64, len(row))
    null = row >= (blocks["n"] - blocks["nulls"]).to_numpy()[block]
    out = pd.DataFrame({"query_place": asked["place"].to_numpy()[q]})
    out["query_id"], out["score"] = asked["query_id"].to_numpy()[q], best.scores[q, at]
    out["place"], out["vec_id"] = places, pd.arrays.IntegerArray(found, null)
    return out


_FOUND = "query_place long, query_id long, score long, place long, vec_id long"


def top_k(
    vectors: DataFrame,
    every: int = 50,
    k: int = K,
    scale: int = SCALE,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): per query the k rows of the largest integer inner product.

    Queries are the rows whose id is divisible by `every`; candidates are all rows but the query's
    own. Ties go to the smaller id, null ids last. Rows with null vectors, or with null or infinite
    entries, take no part; shorter vectors end in zeros. Scaled entries past 2 ** 24 end there.
    Repeated rows are rows of their own, queries as well as candidates; those that tie in score and
    id give equal output. Fewer than k other rows give fewer ranks; empty tables, and tables
    without queries, none. Only the two named columns are read.

    1. Rows are range-sorted by id and cut into blocks with a summary of term maxima.
    2. Each query finds the block of the highest bound over all ranges, from summaries only, and
       scores it: its k-th score there is the floor that every task starts from.
    3. Each task takes a range of blocks and a group of queries, and scores block after block until
       the bounds fall below the k-th score. The best of all ranges are ranked per query.

    Ranges and groups have fixed largest sizes, so a task's memory does not grow with the table.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "topk")
    usable = finite_vectors(vectors.select(id_col, vec_col), vec_col)
    width = usable.agg(F.max(F.size(vec_col))).first()[0] or 0
    rows = usable.select(
        F.col(id_col).cast("long").alias("vec_id"), scaled(F.col(vec_col), scale, LIMIT).alias("x")
    )
    if not width:
        rows, width = rows.withColumn("x", F.array(F.lit(0).cast("long"))), 1
    placed = numbered(rows, scratch, "place", F.asc_nulls_last("vec_id"))
    blocks = scratch.keep(build_blocks(placed, width), "blocks")
    asked = pack_queries(placed.where(F.col("vec_id") % every == 0), width)
    asked = numbered(asked, scratch, "number", F.col("place"))
    asked = scratch.keep(asked, "asked")

    total, queries = placed.count(), asked.count()
    tasks = max(2 * spark.sparkContext.defaultParallelism, 1)
    all_blocks = max(1, -(-total // BLOCK))
    groups = max(1, -(-queries // QUERIES_A_GROUP))
    wanted = max(1, -(-tasks // groups))
    a_range = BLOCK * max(1, min(BLOCKS_A_RANGE, all_blocks // wanted))
    ranges = max(1, -(-total // a_range))
    ranged = blocks.withColumn("range", F.floor(F.col("block") / a_range))
    grouped = asked.withColumn("group", F.floor(F.col("number") / QUERIES_A_GROUP)).drop("number")

    # Summaries and queries meet; every query keeps the block of its highest bound.
    summaries = ranged.select("range", "block", "high", "low", "wide")
    summaries = repeat_rows(summaries.withColumn("_n", F.lit(groups).cast("long")), "_n", "group")
    everywhere = repeat_rows(grouped.withColumn("_n", F.lit(ranges).cast("long")), "_n", "range")
    everywhere, summaries = everywhere.drop("_n"), summaries.drop("_n")

    def highest(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"place": [], "bound": [], "block": []}).astype("int64")
        right = right.sort_values("block", ignore_index=True)
        x = _numbers(left["x"], width)
        most = float(np.abs(x).max()) * float(right["wide"].max()) * width
        bounds = _bounds(x, _numbers(right["high"], width), _numbers(right["low"], width), most < 2**53)
        at = bounds.argmax(axis=1)
        value = bounds[np.arange(len(x)), at]
        return pd.DataFrame({"place": left["place"], "bound": value, "block": right["block"][at].to_numpy()})

    tops = everywhere.groupBy("group", "range").cogroup(summaries.groupBy("group", "range"))
    tops = tops.applyInPandas(highest, "place long, bound long, block long")
    best = F.max(F.struct("bound", (-F.col("block")).alias("block"))).alias("best")
    seeds = tops.groupBy("place").agg(best).select("place", (-F.col("best.block")).alias("block"))
    seeds = scratch.keep(seeds.join(asked, "place"), "seeds")

    # Queries of one block are dealt out in lots, so a block that many queries share is no hot task.
    lots = seeds.withColumn("lot", F.floor(F.col("number") / QUERIES_A_GROUP))
    of_block = lots.select(F.col("block").alias("_block"), F.col("lot").alias("_lot")).distinct()
    seeded = blocks.join(of_block, F.col("block") == F.col("_block"))

    def floors(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"place": [], "floor_score": [], "floor_place": []}).astype("int64")
        found = _search(left, right, width, k)
        return pd.DataFrame(
            {"place": left["place"], "floor_score": found.scores[:, -1], "floor_place": found.places[:, -1]}
        )

    known = lots.groupBy("block", "lot").cogroup(seeded.groupBy("_block", "_lot"))
    known = known.applyInPandas(floors, "place long, floor_score long, floor_place long")
    known = scratch.keep(grouped.join(known, "place"), "floors")

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            names = ["query_place", "query_id", "score", "place", "vec_id"]
            return pd.DataFrame({n: [] for n in names}).astype("Int64")
        return _found(left, right, _search(left, right, width, k))

    whole = repeat_rows(ranged.withColumn("_n", F.lit(groups).cast("long")), "_n", "group").drop("_n")
    all_asked = repeat_rows(known.withColumn("_n", F.lit(ranges).cast("long")), "_n", "range").drop("_n")
    found = all_asked.groupBy("group", "range").cogroup(whole.groupBy("group", "range"))
    found = found.applyInPandas(search, _FOUND)
    order = Window.partitionBy("query_place").orderBy(F.desc("score"), "place")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
