from __future__ import annotations

from dataclasses import replace
from datetime import UTC, date, datetime

import pytest
from pyspark.sql import functions as F

from chronofeat import contracts
from chronofeat.contracts import ContractError, check_contract
from chronofeat.operators import normalize_trips, observed_only, scope_filter, trip_events
from chronofeat.plans.backfill import run_backfill
from chronofeat.settings import Settings
from chronofeat.sources import (
    backfill_range,
    load_new_periods,
    loaded_periods,
    month_folders,
    newest_month_paths,
    newest_periods,
    read_feature_table,
    read_trips,
    register_table,
    with_path_month,
    write_run_record,
    write_table,
)
from chronofeat.sources.tables import read_run_record
from tests.conftest import aware, rows_of

NY = "America/New_York"
HEADER = "ride_id,kind,started_at,ended_at,start_station_name,start_station_id,end_station_id"


def raw(spark, rows):
    return spark.createDataFrame(rows, contracts.RAW_TRIPS.schema)


def test_normalize_keeps_readable_forward_trips_once(spark):
    trips = normalize_trips(
        raw(
            spark,
            [
                ("a", "2026-08-03 08:00:00", "2026-08-03 08:10:00.250", "S1", "S2"),
                ("a", "2026-08-03 07:00:00", "2026-08-03 08:10:00", "S9", "S2"),  # earlier copy
                ("b", "2026-08-03 08:00:00", "2026-08-03 07:59:59", "S1", "S2"),  # ends first
                ("c", "soon", "2026-08-03 08:00:00", "S1", "S2"),
                ("d", "2026-08-03 08:00:00", None, "S1", "S2"),
                ("e", "2026-08-03 08:00:00", "2026-08-03 08:00:00", None, "S2"),
            ],
        ),
        NY,
    )
    got = {r["ride_id"]: r for r in trips.collect()}
    assert set(got) == {"a", "e"}
    assert got["a"]["start_station_id"] == "S9"
    assert aware(got["a"]["started_at"]) == datetime(2026, 8, 3, 11, tzinfo=UTC)


def test_backfill_reads_doubtful_local_times_as_spark_does(spark):
    trips = normalize_trips(
        raw(
            spark,
            [
                ("twice", "2026-11-01 01:30:00", "2026-11-02 00:00:00", "S1", "S2"),
                ("never", "2026-03-08 02:30:00", "2026-03-09 00:00:00", "S1", "S2"),
            ],
        ),
        NY,
    )
    got = {r["ride_id"]: aware(r["started_at"]) for r in trips.collect()}
    assert got["twice"] == datetime(2026, 11, 1, 5, 30, tzinfo=UTC)  # first offset
    assert got["never"] == datetime(2026, 3, 8, 7, 30, tzinfo=UTC)  # pushed forward


def test_a_trip_becomes_two_events(spark):
    trips = normalize_trips(
        raw(
            spark,
            [
                ("a", "2026-08-03 08:00:00", "2026-08-03 08:10:00", "S1", ""),
                ("b", "2026-08-03 08:00:00", "2026-08-03 08:10:00", "S1", "S2"),
            ],
        ),
        NY,
    )
    got = rows_of(trip_events(trips).select("event_id", "station_id", "event_type"))
    assert got == [("a:d", "S1", "departure"), ("b:a", "S2", "arrival"), ("b:d", "S1", "departure")]
    plan = trip_events(trips)._jdf.queryExecution().executedPlan().toString()
    assert "Union" not in plan


def test_scope_and_its_complement_split_the_events(spark, events):
    ev = events([("JC1", "departure", 0), ("HB2", "departure", 0), ("6140.05", "departure", 0)])
    inside = scope_filter(ev, ("JC", "HB"))
    outside = scope_filter(ev, ("JC", "HB"), keep=False)
    assert rows_of(inside.select("station_id")) == [("HB2",), ("JC1",)]
    assert rows_of(outside.select("station_id")) == [("6140.05",)]


def test_scope_and_time_filters_reach_the_scan(spark, events, tmp_path):
    path = str(tmp_path / "ev")
    write_table(events([("JC1", "departure", 0)]), path)
    stored = read_feature_table(spark, contracts.EVENTS, path)
    df = observed_only(
        scope_filter(stored, ("JC",)), "event_ts", datetime(2026, 9, 1, tzinfo=UTC)
    )
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(station_id,JC)" in plan
    assert "LessThanOrEqual(eve" in plan  # the plan text is cut here


def write_csv(folder, name, lines, header=HEADER):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join([header, *lines]) + "\n")


def test_csv_columns_are_found_by_name_and_months_by_path(spark, tmp_path):
    root = tmp_path / "raw"
    write_csv(root / "202607", "a.csv", ["r1,x,2026-07-01 08:00:00,2026-07-01 08:05:00,Main,S1,S2"])
    write_csv(root / "month=202608", "b.csv", ["r2,x,2026-08-01 08:00:00,2026-08-01 08:05:00,Main,0012,S2"])
    trips = read_trips(spark, f"{root}/*/*.csv")
    assert trips.columns == contracts.RAW_TRIPS.columns
    assert {r["start_station_id"] for r in trips.collect()} == {"S1", "0012"}  # text stays text
    dated = with_path_month(spark.read.option("header", True).csv(f"{root}/*/*.csv"))
    assert rows_of(dated.select("ride_id", "month")) == [("r1", "202607"), ("r2", "202608")]
    assert rows_of(newest_periods(dated, "month", 1).select("ride_id")) == [("r2",)]
    several = read_trips(spark, f"{root}/202607", f"{root}/month=202608", columns=["ride_id"])
    assert rows_of(several) == [("r1",), ("r2",)]


def test_files_of_different_layout_are_read_by_their_headers(spark, tmp_path):
    root = tmp_path / "raw"
    write_csv(root, "a.csv", ["r1,x,2026-07-01 08:00:00,2026-07-01 08:05:00,Main,S1,S2"])
    swapped = "ride_id,kind,ended_at,started_at,start_station_name,start_station_id,end_station_id"
    write_csv(root, "b.csv", ["r2,x,2026-07-01 08:05:00,2026-07-01 08:00:00,Main,S1,S2"], swapped)
    more = '\ufeff"end_station_id","a, b",ride_id,started_at,ended_at,start_station_id'
    write_csv(root, "c.csv", ["S2,y,r3,2026-07-01 08:00:00,2026-07-01 08:05:00,S1"], more)
    same = ("2026-07-01 08:00:00", "2026-07-01 08:05:00", "S1", "S2")
    got = read_trips(spark, f"{root}/*.csv")
    assert rows_of(got) == [("r1", *same), ("r2", *same), ("r3", *same)]
    plan = got._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan csv") == 3 and "kind" not in plan


def test_a_csv_without_a_trip_column_is_refused(spark, tmp_path):
    write_csv(tmp_path, "a.csv", ["r1,x"], "ride_id,kind")
    with pytest.raises(ValueError, match="a.csv has no column started_at"):
        read_trips(spark, f"{tmp_path}/*.csv")
    assert rows_of(read_trips(spark, str(tmp_path), columns=["ride_id"])) == [("r1",)]
    with pytest.raises(FileNotFoundError):
        read_trips(spark, f"{tmp_path}/none/*.csv")


def test_months_are_listed_without_opening_files(spark, tmp_path):
    for month in ("202606", "month=202608", "202607", "2026", "notes"):
        write_csv(tmp_path / month, "t.csv", ["not a trip file"], "whatever")
    assert list(month_folders(spark, str(tmp_path))) == ["202606", "202607", "202608"]
    newest = [p.rsplit("/", 1)[1] for p in newest_month_paths(spark, str(tmp_path), 2)]
    assert newest == ["202607", "month=202608"]
    assert len(newest_month_paths(spark, str(tmp_path), 0)) == 3
    assert newest_month_paths(spark, f"{tmp_path}/none", 2) == []
    assert loaded_periods(spark, str(tmp_path), "month") == ["202608"]


def test_loaded_periods_are_skipped_unless_forced(spark, tmp_path):
    path = str(tmp_path / "loaded")

    def batch(text):
        return spark.createDataFrame(
            [("a", text, "202607"), ("b", text, "202608")], "id string, v string, month string"
        )

    load_new_periods(batch("first").where("month = '202607'"), path, "month")
    load_new_periods(batch("second"), path, "month")
    load_new_periods(batch("second"), path, "month")
    read = spark.read.schema("id string, v string, month string").parquet(path)
    assert rows_of(read) == [("a", "first", "202607"), ("b", "second", "202608")]
    load_new_periods(batch("third").where("month = '202607'"), path, "month", force=True)
    spark.catalog.refreshByPath(path)
    read = spark.read.schema("id string, v string, month string").parquet(path)
    assert rows_of(read) == [("a", "third", "202607"), ("b", "second", "202608")]


def test_backfill_range_starts_a_day_before_the_first_month(spark):
    months = spark.createDataFrame([("202608",), ("202607",)], "month string")
    days = [r[0] for r in backfill_range(months, "month", date(2026, 7, 2)).collect()]
    assert days == [date(2026, 6, 30), date(2026, 7, 1), date(2026, 7, 2)]
    none = backfill_range(months.where("false"), "month", date(2026, 7, 2))
    assert none.agg(F.min("day")).first()[0] == date(2026, 3, 3)
    assert none.count() == 122


def test_contracts_are_checked_before_writing(spark, events, tmp_path):
    ev = events([("JC1", "departure", 0), ("JC1", "arrival", 5)])
    path = str(tmp_path / "ev")
    assert write_table(ev.select("event_ts", "event_type", "station_id", "event_id"), path, contracts.EVENTS) == 2
    assert read_feature_table(spark, contracts.EVENTS, path, ["event_id"]).count() == 2
    with pytest.raises(ContractError, match="missing event_id"):
        check_contract(ev.drop("event_id"), contracts.EVENTS)
    with pytest.raises(ContractError, match="unexpected extra"):
        check_contract(ev.withColumn("extra", F.lit(1)), contracts.EVENTS)
    with pytest.raises(ContractError, match="event_type is int, not string"):
        check_contract(ev.withColumn("event_type", F.lit(1)), contracts.EVENTS)


def test_overwriting_a_partitioned_table_replaces_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "days")
    two = spark.createDataFrame([(1, "a"), (2, "b")], "x long, day string")
    assert write_table(two, path, partition_by=("day",)) == 2
    assert write_table(two.where("day = 'b'").withColumn("x", F.lit(9).cast("long")), path, partition_by=("day",)) == 1
    assert rows_of(spark.read.schema("x long, day string").parquet(path)) == [(1, "a"), (9, "b")]


def test_external_table_and_run_record(spark, events, tmp_path):
    path = str(tmp_path / "ev")
    write_table(events([("JC1", "departure", 0)]), path, contracts.EVENTS)
    name = register_table(spark, contracts.EVENTS, path, "test_events")
    assert spark.table(name).schema == contracts.EVENTS.schema
    assert spark.table(name).count() == 1
    other = str(tmp_path / "other")
    write_table(events([("JC1", "departure", m) for m in range(3)]), other, contracts.EVENTS)
    assert spark.table(register_table(spark, contracts.EVENTS, other, name)).count() == 3
    write_table(events([("JC1", "departure", m) for m in range(5)]), other, contracts.EVENTS)
    assert spark.table(register_table(spark, contracts.EVENTS, other, name)).count() == 5
    assert read_feature_table(spark, contracts.EVENTS, path).count() == 1  # files are left alone
    spark.sql(f"DROP TABLE {name}")
    write_run_record(spark, {"rows": {"train": 3}, "features": ["a"]}, str(tmp_path / "rec"))
    assert read_run_record(spark, str(tmp_path / "rec")) == {"rows": {"train": 3}, "features": ["a"]}


def test_backfill_job_writes_every_table(spark, tmp_path):
    lines = [
        f"r{i},x,2026-07-{1 + i // 24:02d} {i % 24:02d}:05:00,2026-07-{1 + i // 24:02d} {i % 24:02d}:25:00,M,JC{i % 3},HB1"
        for i in range(72)
    ]
    write_csv(tmp_path / "raw" / "trips" / "202607", "t.csv", lines + ["zz,x,2026-07-01 00:00:00,2026-07-01 00:10:00,M,5400.1,5400.2"])
    settings = Settings(data_root=str(tmp_path), trip_months=1)
    write_csv(tmp_path / "raw" / "trips" / "202606", "old.csv", ["not read"], "whatever")
    rows = run_backfill(spark, settings)
    assert rows["events"] == 144  # the trip outside the scope is gone
    everywhere = run_backfill(spark, replace(settings, scope="all"))
    assert everywhere["events"] == 146 and run_backfill(spark, replace(settings, scope="nyc"))["events"] == 2
    rows = run_backfill(spark, settings)
    assert spark.table("chronofeat.events").count() == 144
    for contract in (contracts.RECENT_ACTIVITY, contracts.HOURLY_PROFILE, contracts.LABELS):
        folder = "training" if contract is contracts.LABELS else "features"
        stored = read_feature_table(spark, contract, settings.table(folder, contract.name))
        assert stored.count() == rows[contract.name] > 0


def test_settings_come_from_the_environment():
    got = Settings.from_env({"CHRONOFEAT_SCOPE": "nyc", "CHRONOFEAT_TRIP_MONTHS": "6", "CHRONOFEAT_TIMEZONE": ""})
    assert (got.scope, got.trip_months, got.timezone) == ("nyc", 6, NY)
    assert not got.scope_is_prefixed
