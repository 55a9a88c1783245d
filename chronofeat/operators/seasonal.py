"""Hour-of-week profiles and forward-looking labels, over dense grids."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronofeat.functions.timekit import hour_of_week, later
from chronofeat.operators.activity import EVENTS_PER_PART, trailing_activity
from chronofeat.operators.changes import parts_for
from chronofeat.operators.grid import HOUR, KINDS, QUARTER, bucket_counts, dense_grid
from chronofeat.operators.trips import DEPARTURE


def seasonal_profile(
    events: DataFrame,
    tz: str,
    occurrences: int = 4,
    kinds: dict[str, str] = KINDS,
    key: str = "station_id",
    ts: str = "event_ts",
    kind: str = "event_type",
    stamp: str = "event_timestamp",
) -> DataFrame:
    """Mean of the last occurrences of each hour of the week, stamped at the hour's end.

    Fewer occurrences give the mean of what exists. The window per (key, hour of week) runs
    on the partitioning by key that the grid already has: it sorts and does not shuffle. Parts
    follow from the number of events, as hours unfold from few counts.
    """
    counts = bucket_counts(events, HOUR, kinds, key, ts, kind)
    counts = counts.repartition(parts_for(events, events.count(), EVENTS_PER_PART), key)
    hours = dense_grid(counts, HOUR, key)
    hours = hours.withColumn("hour_of_week", hour_of_week(F.col("bucket"), tz))
    recent = (
        Window.partitionBy(key, "hour_of_week").orderBy("bucket").rowsBetween(1 - occurrences, 0)
    )
    means = [F.avg(name).over(recent).alias(f"avg_{name}_{occurrences}w") for name in kinds]
    return hours.select(
        key, "hour_of_week", later(F.col("bucket"), HOUR).alias(stamp), *means
    )


def forward_label(
    events: DataFrame,
    step: timedelta = QUARTER,
    horizon: int = 4,
    counted: str = DEPARTURE,
    key: str = "station_id",
    ts: str = "event_ts",
    kind: str = "event_type",
    stamp: str = "event_timestamp",
    label: str = "target_departures_next_1h",
) -> DataFrame:
    """Events of kind `counted` in the `horizon` buckets from each boundary on.

    That is the trailing count over `horizon` buckets, seen from the window's start. Only the
    tail of a key, where fewer buckets follow, has no label: the first and last `horizon - 1`
    windows reach past the key's buckets and are left out.
    """
    span = step * horizon
    trailing = trailing_activity(
        events, {"n": span}, step, {"_ahead": counted}, key, ts, kind, stamp
    )
    dense = dense_grid(trailing, step, key, stamp, trim=horizon - 1)
    return dense.select(
        key, later(F.col(stamp), -span).alias(stamp), F.col("_ahead_n").alias(label)
    )
