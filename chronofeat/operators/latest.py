"""Newest rows, source precedence and deduplication: one grouped pass each.

All three reduce with `max` or `min` of a struct, which combines before the shuffle. A key or
a group of copies with a third of all rows sends one row per map task.
"""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronofeat.functions.timekit import window_text


def latest_per_key(
    df: DataFrame, keys: list[str], ts: str, tiebreak: tuple[str, ...] = ()
) -> DataFrame:
    """The newest row of each key; ties go to the largest `tiebreak`, then the largest values."""
    lead = [ts, *tiebreak]
    rest = [c for c in df.columns if c not in keys and c not in lead]
    newest = (
        df.where(F.col(ts).isNotNull())
        .groupBy(*keys)
        .agg(F.max(F.struct(*lead, *rest)).alias("_row"))
    )
    return newest.select(*keys, "_row.*").select(*df.columns)


def merge_prefer_first(dfs: list[DataFrame], keys: list[str]) -> DataFrame:
    """The union of `dfs` with one row per key, taken from the first frame that has it."""
    columns = dfs[0].columns
    ranked = [df.withColumn("_source", F.lit(rank)) for rank, df in enumerate(dfs)]
    rest = [c for c in columns if c not in keys]
    first = (
        reduce(DataFrame.unionByName, ranked)
        .groupBy(*keys)
        .agg(F.min(F.struct("_source", *rest)).alias("_row"))
    )
    return first.select(*keys, "_row.*").select(*columns)


def dedupe_events(
    df: DataFrame,
    id: str = "event_id",
    ts: str = "event_ts",
    lateness: timedelta = timedelta(minutes=2),
) -> DataFrame:
    """One row per event id: the earliest on a table, the first seen on a stream.

    On a stream ids are remembered for as long as the watermark allows late events.
    """
    if df.isStreaming:
        return df.withWatermark(ts, window_text(lateness)).dropDuplicatesWithinWatermark([id])
    rest = [c for c in df.columns if c not in (id, ts)]
    first = df.groupBy(id).agg(F.min(F.struct(ts, *rest)).alias("_row"))
    return first.select(id, "_row.*").select(*df.columns)
