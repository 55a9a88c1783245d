"""Trailing activity: sliding counts, with the same rows on tables and on streams."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronofeat.functions.timekit import bucket_start, micros, window_text
from chronofeat.operators.changes import parts_for
from chronofeat.operators.grid import HOUR, KINDS, QUARTER, dense_grid

# Name suffix and length of each trailing window.
WINDOWS = {"15m": QUARTER, "1h": HOUR}
#: Events for each task that works on whole keys. Grids have many rows per event, so it is low.
EVENTS_PER_PART = 50_000


def trailing_activity(
    events: DataFrame,
    windows: dict[str, timedelta] = WINDOWS,
    slide: timedelta = QUARTER,
    kinds: dict[str, str] = KINDS,
    key: str = "station_id",
    ts: str = "event_ts",
    kind: str = "event_type",
    stamp: str = "event_timestamp",
    prebucket: bool | None = None,
) -> DataFrame:
    """Counts in `[end - w, end)` for each window w, at every slide boundary `end`.

    A window without any event gives no row. With `prebucket`, the default on tables, events
    are first counted per slide, partially before the shuffle. Those counts, at most one row
    per key and slide, are moved to their key, spread over the windows there and summed
    without another shuffle. The number of events is taken first, so that there are as many parts
    of keys as the data needs: the counts are small, but what unfolds from them is not. Without
    `prebucket`, the default on streams since it needs one stateful operator less, each event is
    spread over its windows before it is counted.

    On a stream the ends come from `F.window`, which ties the groups to the watermark; on a
    table they are computed, which shuffles one long instead of a struct.
    """
    if any(length % slide for length in windows.values()):
        raise ValueError("each window must be a whole number of slides")
    longest = max(windows.values())
    streaming = events.isStreaming
    prebucket = not streaming if prebucket is None else prebucket

    if prebucket:
        counts = [F.count_if(F.col(kind) == value).alias(name) for name, value in kinds.items()]
        if streaming:
            per_slide = events.groupBy(key, F.window(ts, window_text(slide)).alias("_b"))
            at, event_time = F.col("_b.start"), F.window_time("_b")
        else:
            timed = events.where(F.col(ts).isNotNull())
            per_slide = timed.groupBy(key, bucket_start(F.col(ts), slide).alias("_b"))
            at = event_time = F.col("_b")
        rows, carried = per_slide.agg(*counts), list(kinds)
        if not streaming:
            # Serves the sums per window below, and gap filling per key after them.
            parts = parts_for(events, events.count(), EVENTS_PER_PART)
            rows = rows.repartition(parts, key)
    else:
        at = event_time = F.col(ts)
        rows, carried = events, [F.col(kind).alias("_kind")]

    if streaming:
        ends = F.window(event_time, window_text(longest), window_text(slide)).alias("_w")
        end = F.col("_w.end")
    else:
        offsets = F.array(*[F.lit(micros(slide) * (i + 1)) for i in range(longest // slide)])
        rows = rows.where(event_time.isNotNull()).withColumn("_offset", F.explode(offsets))
        ends = F.timestamp_micros(F.unix_micros(bucket_start(event_time, slide)) + F.col("_offset"))
        ends = ends.alias("_w")
        end = F.col("_w")
    placed = rows.select(key, *carried, at.alias("_at"), ends)
    # How far before the window's end the event lies, as one number for all conditions.
    placed = placed.withColumn("_age", F.unix_micros(end) - F.unix_micros("_at"))

    def count(name: str, value: str, length: timedelta) -> Column:
        inside = F.col("_age") <= micros(length)
        if prebucket:
            return F.sum(F.when(inside, F.col(name)).otherwise(0))
        return F.count_if((F.col("_kind") == value) & inside)

    counted = placed.groupBy(key, "_w").agg(
        *[
            count(name, value, length).alias(f"{name}_{suffix}")
            for name, value in kinds.items()
            for suffix, length in windows.items()
        ]
    )
    names = [f"{name}_{suffix}" for name in kinds for suffix in windows]
    return counted.select(key, end.alias(stamp), *names)


def activity_with_zeros(
    events: DataFrame,
    windows: dict[str, timedelta] = WINDOWS,
    slide: timedelta = QUARTER,
    kinds: dict[str, str] = KINDS,
    key: str = "station_id",
    ts: str = "event_ts",
    kind: str = "event_type",
    stamp: str = "event_timestamp",
    prebucket: bool | None = None,
) -> DataFrame:
    """`trailing_activity` of the events and their heartbeats: no boundary is missing.

    Heartbeats count as nothing, so what they add are exactly the zero rows between a key's
    first and last window. Filling those gaps gives the same table from one scan.
    """
    rows = trailing_activity(events, windows, slide, kinds, key, ts, kind, stamp, prebucket)
    return dense_grid(rows, slide, key, stamp)
