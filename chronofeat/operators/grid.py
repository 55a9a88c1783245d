"""Bucket counts, dense grids and heartbeats.

Everything here counts per (key, bucket) first, with a partial count before the shuffle.
After that a key has at most one row per bucket of its time span, however many events it
had, so the per-key windows that follow are bounded by span / step and not by the data.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronofeat.functions.columns import event_id
from chronofeat.functions.timekit import bucket_start, event_time_from_millis, later
from chronofeat.operators.trips import ARRIVAL, DEPARTURE, HEARTBEAT

QUARTER = timedelta(minutes=15)
HOUR = timedelta(hours=1)
KINDS = {"departures": DEPARTURE, "arrivals": ARRIVAL}


def bucket_counts(
    events: DataFrame,
    step: timedelta,
    kinds: dict[str, str] = KINDS,
    key: str = "station_id",
    ts: str = "event_ts",
    kind: str = "event_type",
    bucket: str = "bucket",
) -> DataFrame:
    """Events per key and bucket, one count column per entry of `kinds`.

    A bucket holding only events of other kinds gives a row of zeros.
    """
    counts = [F.count_if(F.col(kind) == value).alias(name) for name, value in kinds.items()]
    at = bucket_start(F.col(ts), step).alias(bucket)
    return events.where(F.col(ts).isNotNull()).groupBy(key, at).agg(*counts)


def dense_grid(
    counts: DataFrame,
    step: timedelta,
    key: str = "station_id",
    ts: str = "bucket",
    trim: int = 0,
) -> DataFrame:
    """Every bucket of a key from its first to its last, with zeros where it had no row.

    `counts` has one row per (key, bucket). Each row fills the gap up to the next one, so
    only the rows that exist are sorted, and there is no grid to build and no join. `trim`
    leaves out that many of the first and of the last rows of each key.
    """
    values = [c for c in counts.columns if c not in (key, ts)]
    by_time = Window.partitionBy(key).orderBy(ts)
    until = F.coalesce(later(F.lead(ts).over(by_time), -step), F.col(ts))
    rows = counts.withColumn("_until", until)
    if trim:
        before, after = F.lag(ts, trim).over(by_time), F.lead(ts, trim).over(by_time)
        rows = rows.withColumn("_inner", before.isNotNull() & after.isNotNull()).where("_inner")
    filled = every_step(rows, ts, "_until", step, "_at")
    own = F.col("_at") == F.col(ts)
    zero_in_gap = [F.when(own, F.col(v)).otherwise(0).alias(v) for v in values]
    return filled.select(key, F.col("_at").alias(ts), *zero_in_gap)


def every_step(
    rows: DataFrame, first: str, last: str, step: timedelta, at: str, stretch: int = 2048
) -> DataFrame:
    """Each row once for every `step` from its `first` to its `last` time, which goes to `at`.

    Long gaps unfold in two levels, stretches of steps and then their steps, and rows of stretches
    are written one by one, so no array grows with the gap.
    """
    wide = step * stretch
    steps = F.sequence("_stretch", F.least(later(F.col("_stretch"), wide - step), F.col(last)), F.lit(step))
    stretches = rows.withColumn("_stretch", F.explode(F.sequence(first, last, F.lit(wide))))
    return stretches.withColumn(at, F.explode(steps)).drop("_stretch")


def heartbeats(
    events: DataFrame,
    step: timedelta = QUARTER,
    key: str = "station_id",
    ts: str = "event_ts",
    kind: str = "event_type",
    id: str = "event_id",
) -> DataFrame:
    """One event that counts as nothing, per key and bucket across the key's history.

    The id carries epoch milliseconds, as the ids made from live status messages do.
    """
    at = bucket_start(F.col(ts), step).alias(ts)
    seen = events.where(F.col(ts).isNotNull()).select(key, at).distinct()
    grid = dense_grid(seen, step, key, ts)
    return grid.select(
        event_id("hb", F.col(key), F.unix_millis(ts)).alias(id),
        key,
        F.lit(HEARTBEAT).alias(kind),
        ts,
    )


def status_heartbeats(status: DataFrame) -> DataFrame:
    """Status messages as heartbeat events: a station that reports is alive, trips or not."""
    return status.select(
        event_id("hb", F.col("station_id"), F.col("event_ts_ms")).alias("event_id"),
        "station_id",
        F.lit(HEARTBEAT).alias("event_type"),
        event_time_from_millis(F.col("event_ts_ms")).alias("event_ts"),
    )
