"""Time: buckets, local calendars, epoch conversions and whole-week shifts."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

HOUR = timedelta(hours=1)
WEEK = timedelta(weeks=1)
_HOURS_PER_WEEK = 168
_EPOCH_HOUR_OF_WEEK = 72  # 1970-01-01 was a Thursday


def instant(value: datetime) -> Column:
    """A literal for a zoned moment; a naive one would depend on the machine's own zone."""
    if value.tzinfo is None:
        raise ValueError(f"{value} has no time zone")
    return F.lit(value)


def micros(step: timedelta) -> int:
    return step // timedelta(microseconds=1)


def window_text(step: timedelta) -> str:
    """`step` as the duration text that `F.window` and `withWatermark` take."""
    return f"{micros(step)} microseconds"


def bucket_start(ts: Column, step: timedelta) -> Column:
    """Start of the UTC-aligned bucket holding `ts`. Integer arithmetic, no session time zone."""
    us = F.unix_micros(ts)
    return F.timestamp_micros(us - F.pmod(us, F.lit(micros(step))))


def later(ts: Column, by: timedelta) -> Column:
    """`ts` and so much time after it, less where `by` is negative.

    Adds whole microseconds. A sum with an interval goes over the calendar of the session's zone, row
    by row, for the same instant in UTC.
    """
    return F.timestamp_micros(F.unix_micros(ts) + F.lit(micros(by)))


def event_time_from_millis(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def hour_of_week(ts: Column, tz: str) -> Column:
    """0 for Monday 00:00 in `tz` up to 167 for Sunday 23:00.

    Counted in whole local hours since the epoch, which was a Thursday at midnight.
    """
    local_hours = F.floor(F.unix_seconds(F.from_utc_timestamp(ts, tz)) / 3600)
    return F.pmod(local_hours + _EPOCH_HOUR_OF_WEEK, F.lit(_HOURS_PER_WEEK)).cast("long")


def local_wall_time(text: Column) -> Column:
    """Wall-clock text as a timestamp carrying the wall reading; null where unreadable."""
    return F.try_to_timestamp(text)


def local_to_utc_strict(wall: Column, tz: str) -> Column:
    """The instant a wall reading names in `tz`, or null where it names none or two.

    The offsets in force a day before and a day after give the two candidate instants; a
    candidate counts when it reads back as `wall`. In a skipped hour neither does, in a
    repeated hour both do and they differ. No overlap length is assumed.
    """
    day = F.lit(timedelta(days=1))

    def candidate(nearby: Column) -> Column:
        return wall - (F.from_utc_timestamp(nearby, tz) - nearby)

    before, after = candidate(wall - day), candidate(wall + day)
    before_fits = F.from_utc_timestamp(before, tz) == wall
    after_fits = F.from_utc_timestamp(after, tz) == wall
    twice = before_fits & after_fits & (before != after)
    return F.when(before_fits & ~twice, before).when(after_fits & ~twice, after)


def wall_reading(moment: datetime, tz: str) -> datetime:
    """What a clock in `tz` shows at `moment` (driver side, one value)."""
    return moment.astimezone(ZoneInfo(tz)).replace(tzinfo=None)


def wall_literal(wall: datetime) -> Column:
    """A literal that equals the timestamp carrying that wall reading."""
    return F.lit(wall.replace(tzinfo=UTC))


def moment_of(wall: datetime, tz: str) -> datetime:
    """The moment a wall reading names in `tz` (driver side, one value)."""
    return wall.replace(tzinfo=ZoneInfo(tz)).astimezone(UTC)


def weeks_to_shift(data_end: datetime, now_local: datetime) -> int:
    """Fewest whole weeks that move `data_end` to `now_local` or later; never negative."""
    return max(0, -((data_end - now_local) // WEEK))
