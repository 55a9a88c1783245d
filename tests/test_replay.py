from __future__ import annotations

from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from chronofeat.contracts import RAW_TRIPS
from chronofeat.functions import hour_of_week, local_wall_time
from chronofeat.plans.replay import (
    data_span,
    local_events,
    replay,
    replay_slices,
    shift_weeks,
)

NY = "America/New_York"


def walls(spark, *texts):
    df = spark.createDataFrame([(f"r{i}", "S", "departure", t) for i, t in enumerate(texts)], "ride_id string, station_id string, event_type string, t string")
    return df.select("ride_id", "station_id", "event_type", local_wall_time(F.col("t")).alias("local_ts"))


def test_shifts_keep_the_local_hour_of_the_week(spark):
    ev = walls(spark, "2026-08-03 08:15:00", "2026-08-09 23:30:00")
    shifted = shift_weeks(ev, 14, NY)  # into November, after the change
    got = shifted.orderBy("ride_id").select(hour_of_week(F.col("event_ts"), NY)).collect()
    assert [r[0] for r in got] == [8, 6 * 24 + 23]


def test_shifts_drop_times_that_become_doubtful(spark):
    ev = walls(spark, "2026-10-25 01:30:00", "2026-10-25 00:30:00", "2026-03-01 02:30:00")
    assert [r[0] for r in shift_weeks(ev, 1, NY).select("ride_id").collect()] == ["r1"]


def test_a_slice_is_open_below_and_closed_above_with_ids_per_pass(spark):
    ev = walls(spark, "2026-08-01 00:00:00", "2026-08-03 08:00:00", "2026-08-03 08:30:00", "2026-08-10 12:00:00")
    since = datetime(2026, 8, 17, 12, tzinfo=UTC)  # 08:00 local, two weeks on
    got = replay(ev, NY, since, since + timedelta(minutes=30)).collect()
    assert replay(ev, NY, since, since + timedelta(minutes=30), weeks=2).select("event_id").collect()[0][0] == "r2:d:2"


def test_the_default_shift_covers_the_end_of_the_slice(spark):
    ev = walls(spark, "2026-08-01 00:00:00", "2026-08-10 07:00:00", "2026-08-10 08:00:00")
    as_of = datetime(2026, 8, 17, 12, tzinfo=UTC)  # 08:00 local: one week after the end
    got = replay(ev, NY, as_of - timedelta(minutes=75), as_of).collect()
    assert {r["event_id"] for r in got} == {"r1:d:1", "r2:d:1"}
    assert max(r["event_ts_ms"] for r in got) == int(as_of.timestamp() * 1000)


def test_short_histories_cannot_be_replayed(spark):
    with pytest.raises(ValueError, match="more than a week"):
        data_span(walls(spark, "2026-08-03 08:00:00", "2026-08-10 09:14:59"))
    first, last = data_span(walls(spark, "2026-08-03 08:00:00", "2026-08-10 09:15:00.5"))
    assert (first, last) == (datetime(2026, 8, 3, 8), datetime(2026, 8, 10, 9, 15, 0, 500000))
    with pytest.raises(ValueError, match="no events"):
        data_span(walls(spark, "never"))


def test_long_slices_are_cut_where_the_shift_steps_up():
    end = datetime(2026, 8, 10, 8)
    since = datetime(2026, 8, 17, 11, tzinfo=UTC)
    step = datetime(2026, 8, 17, 12, tzinfo=UTC)  # the shifted end
    pieces = replay_slices(end, NY, since, step + timedelta(hours=1))
    assert pieces == [(since, step, 1), (step, step + timedelta(hours=1), 2)]
    assert replay_slices(end, NY, since, step) == [(since, step, 1)]


def test_raw_trips_become_local_events_in_one_pass(spark):
    raw = spark.createDataFrame(
        [("a", "2026-08-03 08:00:00", "bad", "JC1", "HB1"), ("b", "2026-08-03 09:00:00", "2026-08-03 08:00:00", "", "6140")],
        RAW_TRIPS.schema,
    )
    kinds = lambda df: sorted((r["ride_id"], r["event_type"]) for r in df.collect())
    assert kinds(local_events(raw)) == [("a", "departure"), ("b", "arrival")]
    assert kinds(local_events(raw, ("JC", "HB"))) == [("a", "departure")]
    assert kinds(local_events(raw, ("JC", "HB"), keep=False)) == [("b", "arrival")]
