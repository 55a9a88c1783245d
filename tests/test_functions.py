from __future__ import annotations

from datetime import UTC, datetime, timedelta
from pathlib import Path
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from chronofeat import session
from chronofeat.functions import (
    age_label,
    as_number,
    bucket_start,
    clean_numeric,
    event_id,
    hour_of_week,
    instant,
    local_to_utc_strict,
    local_wall_time,
    net_flow,
    weeks_to_shift,
)
from chronofeat.session import drop_staged, stage_table
from tests.conftest import aware

NY = "America/New_York"


@pytest.mark.parametrize("session_zone", ["UTC", "Asia/Tokyo"])
def test_hour_of_week_equals_the_calendar_around_clock_changes(spark, session_zone):
    stamps = [datetime(1969, 12, 28, 23, 59, tzinfo=UTC)]
    for start in (datetime(2026, 3, 7, tzinfo=UTC), datetime(2026, 10, 31, tzinfo=UTC)):
        stamps += [start + timedelta(minutes=30 * i) for i in range(150)]
    wall = [s.astimezone(ZoneInfo(NY)) for s in stamps]
    expected = [w.weekday() * 24 + w.hour for w in wall]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(stamps)], "i int, ts timestamp")
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        got = df.orderBy("i").select(hour_of_week(F.col("ts"), NY)).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [r[0] for r in got] == expected


def test_monday_midnight_is_zero_and_sunday_ends_the_week(spark):
    df = spark.createDataFrame(
        [(datetime(2026, 8, 3, 4, tzinfo=UTC),), (datetime(2026, 8, 10, 3, 59, tzinfo=UTC),)],
        "ts timestamp",
    )
    assert [r[0] for r in df.select(hour_of_week(F.col("ts"), NY)).collect()] == [0, 167]


def test_buckets_are_aligned_to_utc_before_and_after_the_epoch(spark):
    df = spark.sql(
        "SELECT timestamp'1969-12-31 23:59:59.999999Z' AS a, timestamp'2024-01-01 00:15:00Z' AS b"
    )
    quarter = timedelta(minutes=15)
    row = df.select(bucket_start(F.col("a"), quarter), bucket_start(F.col("b"), quarter)).first()
    assert aware(row[0]) == datetime(1969, 12, 31, 23, 45, tzinfo=UTC)
    assert aware(row[1]) == datetime(2024, 1, 1, 0, 15, tzinfo=UTC)


@pytest.mark.parametrize(
    ("zone", "wall", "expected"),
    [
        (NY, "2026-03-08 01:59:59", "2026-03-08 06:59:59"),
        (NY, "2026-03-08 02:30:00", None),  # skipped
        (NY, "2026-03-08 03:00:00", "2026-03-08 07:00:00"),
        (NY, "2026-11-01 00:59:59", "2026-11-01 04:59:59"),
        (NY, "2026-11-01 01:30:00", None),  # occurs twice
        (NY, "2026-11-01 02:00:00", "2026-11-01 07:00:00"),
        ("Australia/Lord_Howe", "2026-04-05 01:45:00", None),  # half-hour overlap
        ("Australia/Lord_Howe", "2026-04-05 02:00:00", "2026-04-04 15:30:00"),
        ("Australia/Lord_Howe", "2026-10-04 02:10:00", None),  # half-hour gap
        ("UTC", "2026-03-08 02:30:00", "2026-03-08 02:30:00"),
    ],
)
def test_strict_local_times(spark, zone, wall, expected):
    df = spark.createDataFrame([(wall,)], "w string")
    got = df.select(local_to_utc_strict(local_wall_time(F.col("w")), zone).cast("string")).first()
    assert got[0] == expected


def test_weeks_to_shift_is_the_smallest_cover():
    end = datetime(2026, 8, 9, 23, 30)
    assert weeks_to_shift(end, end) == 0
    assert weeks_to_shift(end, end - timedelta(days=30)) == 0
    assert weeks_to_shift(end, end + timedelta(microseconds=1)) == 1
    assert weeks_to_shift(end, end + timedelta(weeks=2)) == 2


def test_age_labels_change_unit_at_their_limits(spark):
    cases = {
        None: "no data", 0: "0 s old", 119: "119 s old", 120: "2 min old", 150: "2 min old",
        210: "4 min old", 7199: "120 min old", 7200: "2 h old", 172799: "48 h old",
        172800: "2 days old", 8640000: "100 days old",
    }
    df = spark.createDataFrame([(None if a is None else float(a),) for a in cases], "a double")
    assert [r[0] for r in df.select(age_label(F.col("a"))).collect()] == list(cases.values())


def test_small_columns(spark):
    df = spark.sql("SELECT double('NaN') AS n, 1.5D AS x, CAST(NULL AS DOUBLE) AS z, 'r' AS s, 'q' AS bad")
    row = df.select(
        clean_numeric(F.col("n")), clean_numeric(F.col("x")), clean_numeric(F.col("z")),
        event_id(F.col("s"), "d", F.lit(3)), net_flow(F.col("x"), F.col("z")),
        as_number(F.col("bad")), as_number(F.col("x")),
    ).first()
    assert tuple(row) == (None, 1.5, None, "r:d:3", None, None, 1.5)


def test_moments_need_a_zone():
    with pytest.raises(ValueError, match="no time zone"):
        instant(datetime(2026, 1, 1))


def test_staged_tables_can_be_dropped(spark, monkeypatch):
    monkeypatch.setattr(session, "_MADE", [])  # those of other tests stay
    kept = stage_table(spark.range(3), "kept")
    paths = kept.inputFiles()
    assert kept.count() == 3 and drop_staged(spark) >= 1
    assert not any(Path(p.removeprefix("file:")).exists() for p in paths)
    assert drop_staged(spark) == 0
