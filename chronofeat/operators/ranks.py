"""Exact order statistics without sorting the data or gathering it anywhere."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HISTOGRAM_BINS = 65_536


def order_statistic(
    df: DataFrame,
    value: Column,
    rank: int,
    within: Callable[[int, int], Column] | None = None,
    span: tuple[int, int] | None = None,
) -> tuple[int, int]:
    """The value at 0-based `rank` of the non-null longs `value`, and how many lie below it.

    Each pass counts the remaining range in at most 65,536 bins and goes on with the bin that
    holds the rank, until that bin has a single value. Only one row per pass reaches the
    driver, and the running count runs over the bins, never over the rows. `within` may give
    the range filter in a form that reaches the scan, and `span` the smallest and largest value where
    they are known.
    """
    within = within or (lambda low, high: value.between(low, high))
    low, high = span or df.agg(F.min(value), F.max(value)).first()
    if low is None:
        raise ValueError("no values to rank")
    below = 0
    while low < high:
        width = (high - low) // HISTOGRAM_BINS + 1
        offset = value - F.lit(low)
        bins = (
            df.where(within(low, high))
            .groupBy((offset - F.pmod(offset, F.lit(width))).alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"), F.min(value).alias("low"), F.max(value).alias("high"))
        )
        # One task sees at most HISTOGRAM_BINS rows here.
        running = bins.withColumn("upto", F.sum("n").over(Window.orderBy("bin")))
        hit = running.where(F.col("upto") > rank - below).orderBy("bin").first()
        below += hit["upto"] - hit["n"]
        low, high = hit["low"], hit["high"]
    return low, below


def exact_quantile(df: DataFrame, ts: str, q: float) -> float:
    """The `q` quantile of a timestamp column in epoch microseconds, linearly interpolated."""
    value = F.unix_micros(ts)
    rows, *span = df.agg(F.count(ts), F.min(value), F.max(value)).first()
    position = (rows - 1) * q
    rank = int(position)

    def within(low: int, high: int) -> Column:
        first, last = F.timestamp_micros(F.lit(low)), F.timestamp_micros(F.lit(high))
        return F.col(ts).between(first, last)

    at, _ = order_statistic(df, value, rank, within, tuple(span))
    if position == rank:
        return float(at)
    upto, after = df.agg(
        F.count_if(value <= at), F.min(F.when(value > at, value))
    ).first()
    neighbour = at if upto > rank + 1 else after
    return at + (position - rank) * (neighbour - at)


def seeded_cap(df: DataFrame, n: int, seed: int = 7, ticket: Column | None = None) -> DataFrame:
    """At most `n` rows, chosen by a seeded hash of the whole row: the same rows every time.

    `ticket` may give another number per row, a long that is never negative; the lowest stay.

    The hash value of the n-th row is found by counting, and rows at or under it are kept, so
    no task gathers the sample. Of rows with an equal number, which by the hash are copies of each
    other, a limit picks as many as still fit.
    """
    total = df.count()
    if total <= n:
        return df
    # Halving the hash keeps differences of two values inside a long.
    if ticket is None:
        ticket = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *df.columns), 1)
    last, below = order_statistic(df, ticket, n - 1)
    return df.where(ticket < last).unionAll(df.where(ticket == last).limit(n - below))
