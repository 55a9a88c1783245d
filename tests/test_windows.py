from __future__ import annotations

import random
from collections import Counter
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from chronofeat.operators import (
    activity_with_zeros,
    bucket_counts,
    dense_grid,
    forward_label,
    heartbeats,
    seasonal_profile,
    status_heartbeats,
    trailing_activity,
)
from chronofeat.operators.grid import QUARTER, every_step
from tests.conftest import MONDAY_NOON, aware, rows_of

NY = "America/New_York"
NAMES = ["departures_15m", "departures_1h", "arrivals_15m", "arrivals_1h"]


def by_minute(df, *names):
    """{(station, minutes after noon): values}"""
    return {
        (r["station_id"], (aware(r["event_timestamp"]) - MONDAY_NOON) // timedelta(minutes=1)): tuple(
            r[n] for n in names
        )
        for r in df.collect()
    }


def some_events(n=300, stations=4, minutes=3000, seed=3):
    pick = random.Random(seed)
    kinds = ["departure", "arrival", "heartbeat", None]
    return [
        (f"S{pick.randrange(stations)}", pick.choice(kinds), pick.randrange(minutes))
        for _ in range(n)
    ]


@pytest.mark.parametrize("prebucket", [False, True])
def test_windows_are_half_open(events, prebucket):
    rows = [("A", "departure", 4), ("A", "arrival", 44), ("A", "departure", 58), ("A", "departure", 60)]
    got = by_minute(trailing_activity(events(rows), prebucket=prebucket), *NAMES)
    assert got["A", 60] == (1, 2, 0, 1)  # minute 60 itself is not in [0, 60)
    assert got["A", 75] == (1, 2, 0, 1)  # minute 4 has left
    assert ("A", 135) not in got  # nothing in [75, 135)
    assert max(minute for _, minute in got) == 120


@pytest.mark.parametrize("prebucket", [False, True])
def test_windows_equal_a_direct_count(events, prebucket):
    rows = some_events()
    got = by_minute(trailing_activity(events(rows), prebucket=prebucket), *NAMES)
    expected = {}
    for station in {s for s, _, _ in rows}:
        for end in range(15, 3100, 15):
            inside = [(k, m) for s, k, m in rows if s == station and end - 60 <= m < end]
            if inside:
                near = Counter(k for k, m in inside if m >= end - 15)
                far = Counter(k for k, _ in inside)
                expected[station, end] = (near["departure"], far["departure"], near["arrival"], far["arrival"])
    assert got == expected


def test_windows_must_be_whole_slides(events):
    with pytest.raises(ValueError, match="whole number"):
        trailing_activity(events([]), windows={"20m": timedelta(minutes=20)})


def test_activity_with_zeros_equals_counting_events_and_heartbeats(events):
    ev = events(some_events())
    composed = trailing_activity(ev.unionByName(heartbeats(ev)))
    assert rows_of(activity_with_zeros(ev)) == rows_of(composed)


def test_quiet_stations_have_a_row_at_every_boundary(events):
    ev = events([("A", "departure", 3), ("A", "arrival", 190), ("B", "arrival", 0)])
    got = by_minute(activity_with_zeros(ev), *NAMES)
    minutes = sorted(m for s, m in got if s == "A")
    assert minutes == list(range(15, 255, 15))
    assert got["A", 120] == (0, 0, 0, 0)
    assert got["A", 60] == (0, 1, 0, 0)


def test_heartbeats_cover_each_station_by_itself(events):
    ev = events([("A", "departure", 3), ("A", "arrival", 65), ("B", "arrival", 500)])
    beats = heartbeats(ev)
    ms = int(MONDAY_NOON.timestamp() * 1000)
    got = rows_of(beats.select("event_id", "event_type"))
    assert got == sorted(
        [(f"hb:A:{ms + 900_000 * i}", "heartbeat") for i in range(5)]
        + [(f"hb:B:{ms + 900_000 * 33}", "heartbeat")]
    )


def test_status_messages_are_heartbeats_with_the_same_ids(spark, events):
    status = spark.createDataFrame([("A", int(MONDAY_NOON.timestamp() * 1000))], "station_id string, event_ts_ms long")
    batch = heartbeats(events([("A", "departure", 3)]))
    assert rows_of(status_heartbeats(status)) == rows_of(batch)


def test_dense_grid_fills_between_first_and_last_only(events):
    counts = bucket_counts(events([("A", "departure", 1), ("A", "arrival", 50), ("B", "x", 7)]), QUARTER)
    grid = dense_grid(counts, QUARTER).withColumnRenamed("bucket", "event_timestamp")
    got = by_minute(grid, "departures", "arrivals")
    assert got == {("A", 0): (1, 0), ("A", 15): (0, 0), ("A", 30): (0, 0), ("A", 45): (0, 1), ("B", 0): (0, 0)}


def test_labels_look_ahead_and_stop_where_the_hour_is_incomplete(events):
    rows = [("A", "departure", 5), ("A", "departure", 25), ("A", "arrival", 40), ("A", "departure", 80), ("A", "departure", 210), ("B", "departure", 0)]
    got = by_minute(forward_label(events(rows)), "target_departures_next_1h")
    assert got["A", 0] == (2,)
    assert got["A", 15] == (1,)  # 25; 80 is past the hour
    assert got["A", 30] == (1,)  # 80
    assert got["A", 90] == (0,)  # a real zero
    assert max(m for _, m in got) == 210 - 45
    assert not any(s == "B" for s, _ in got)  # fewer than four buckets


def test_labels_equal_a_direct_count(events):
    rows = some_events(200)
    got = by_minute(forward_label(events(rows)), "target_departures_next_1h")
    expected = {}
    for station in {s for s, _, _ in rows}:
        own = [(k, m) for s, k, m in rows if s == station]
        buckets = [m // 15 for _, m in own]
        for b in range(min(buckets), max(buckets) - 2):
            ahead = sum(k == "departure" and 15 * b <= m < 15 * b + 60 for k, m in own)
            expected[station, 15 * b] = (ahead,)
    assert got == expected


def test_profile_averages_the_last_four_weeks_and_is_stamped_at_the_hours_end(events):
    week = 7 * 24 * 60
    rows = [("A", "departure", w * week + m) for w, n in enumerate([2, 4, 6, 8, 10]) for m in range(n)]
    profile = seasonal_profile(events(rows), NY).where("hour_of_week = 8")
    got = by_minute(profile, "avg_departures_4w", "avg_arrivals_4w")
    means = {w: mean for w, mean in enumerate([2.0, 3.0, 4.0, 5.0, 7.0])}
    assert got == {("A", w * week + 60): (mean, 0.0) for w, mean in means.items()}


def test_profile_counts_the_repeated_hour_twice(spark, events):
    start = datetime(2026, 11, 1, 4, 30, tzinfo=UTC)  # 00:30 local; 01:xx occurs twice
    minutes = int((start - MONDAY_NOON).total_seconds() // 60)
    profile = seasonal_profile(events([("A", "departure", minutes), ("A", "arrival", minutes + 240)]), NY)
    repeated = profile.where(F.col("hour_of_week") == 6 * 24 + 1)
    assert repeated.count() == 2


def test_no_ordering_is_done_over_raw_rows(events):
    """Windows run over counts: the plan aggregates below every window."""
    for table in (activity_with_zeros(events([])), seasonal_profile(events([]), NY), forward_label(events([]))):
        plan = table._jdf.queryExecution().sparkPlan().toString()
        assert "HashAggregate" in plan[plan.index("Window") :]
        assert "Join" not in plan


def test_a_long_gap_unfolds_without_a_long_array(spark):
    """1970 and 2024 in one key: 1.9 million buckets, in arrays of 2,048 at most."""
    counts = spark.createDataFrame(
        [("a", datetime(1970, 1, 1, tzinfo=UTC), 3), ("a", datetime(2024, 1, 1, tzinfo=UTC), 4)],
        "station_id string, bucket timestamp, n int",
    )
    grid = dense_grid(counts, QUARTER)
    steps = (datetime(2024, 1, 1) - datetime(1970, 1, 1)) // QUARTER + 1
    assert grid.agg(F.count("*"), F.countDistinct("bucket"), F.sum("n")).first() == (steps, steps, 7)
    arrays = every_step(counts.withColumn("end", F.col("bucket") + F.lit(QUARTER * 5000)), "bucket", "end", QUARTER, "at")
    assert arrays.count() == 2 * 5001
    found = arrays.where("n = 3").agg(F.min("at"), F.max("at"), F.countDistinct("at")).first()
    assert found[2] == 5001


@pytest.mark.parametrize("build", [activity_with_zeros, forward_label, lambda ev: seasonal_profile(ev, NY)])
def test_grids_unfold_in_as_many_parts_as_the_events_need(events, monkeypatch, build):
    """Counts are too small for the planner to see how many rows a task will unfold from them."""
    from chronofeat.operators import activity, changes, seasonal

    ev = events(some_events(n=400, stations=40))
    whole = rows_of(build(ev))
    for module in (activity, seasonal):
        monkeypatch.setattr(module, "EVENTS_PER_PART", 20)
    monkeypatch.setattr(changes, "LEAST_PER_PART", 10_000)
    table = build(ev)
    assert table.rdd.getNumPartitions() == 20
    assert rows_of(table) == whole
