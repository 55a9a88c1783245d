"""Trips: text rows to typed UTC rows, and one trip to its two events."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronofeat.functions.columns import event_id, starts_with_any
from chronofeat.functions.timekit import instant, local_wall_time

# Event kinds and the letter that marks them in event ids.
DEPARTURE, ARRIVAL, HEARTBEAT = "departure", "arrival", "heartbeat"
KIND_MARK = {DEPARTURE: "d", ARRIVAL: "a"}


def normalize_trips(raw: DataFrame, tz: str) -> DataFrame:
    """Typed trips, one per ride: readable times, and an end not before the start.

    Of several rows of one ride the earliest (by start, end, stations) stays, so the result
    does not depend on the order of the input. Copies collapse before the shuffle.
    """
    times, places = ("started_at", "ended_at"), ("start_station_id", "end_station_id")
    typed = {c: F.to_utc_timestamp(local_wall_time(F.col(c)), tz) for c in times}
    valid = raw.withColumns(typed).where(F.col("ended_at") >= F.col("started_at"))
    first = F.min(F.struct(*times, *places)).alias("t")
    return valid.groupBy("ride_id").agg(first).select("ride_id", "t.*")


def trip_ends(
    trips: DataFrame, time: Callable[[Column], Column], at: str, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Two rows per trip, from one pass: where and when it started, and where and when it ended.

    `time` makes the time `at` of a trip's column; rows without a station, or without a time, go.
    """
    sides = {
        DEPARTURE: ("start_station_id", "started_at"),
        ARRIVAL: ("end_station_id", "ended_at"),
    }
    rows = [
        F.struct(
            *keep,
            F.lit(kind).alias("event_type"),
            F.col(station).alias("station_id"),
            time(F.col(moment)).alias(at),
        )
        for kind, (station, moment) in sides.items()
    ]
    ends = trips.select(F.inline(F.array(*rows)))
    return ends.where((F.length("station_id") > 0) & F.col(at).isNotNull())


def kind_mark(kind: Column) -> Column:
    """The letter that stands for a kind in event ids."""
    return F.create_map(*[F.lit(x) for pair in KIND_MARK.items() for x in pair])[kind]


def trip_events(trips: DataFrame) -> DataFrame:
    """A departure and an arrival per trip; events without a station go."""
    ends = trip_ends(trips, lambda moment: moment, "event_ts", keep=("ride_id",))
    name = event_id(F.col("ride_id"), kind_mark(F.col("event_type")))
    return ends.select(name.alias("event_id"), "station_id", "event_type", "event_ts")


def scope_filter(
    df: DataFrame, prefixes: tuple[str, ...], key: str = "station_id", keep: bool = True
) -> DataFrame:
    """Rows whose key starts with one of `prefixes`, or with none of them; all without prefixes."""
    if not prefixes:
        return df
    inside = starts_with_any(F.col(key), prefixes)
    return df.where(inside if keep else ~inside)


def observed_only(df: DataFrame, ts: str, as_of: datetime) -> DataFrame:
    """Rows not later than `as_of`. A plain comparison, so it reaches the scan."""
    return df.where(F.col(ts) <= instant(as_of))
