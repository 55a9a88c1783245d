from __future__ import annotations

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from chronofeat.operators import dedupe_events, latest_per_key, merge_prefer_first
from chronofeat.plans.backfill import newest_observation, weather_history
from chronofeat.plans.online import (
    compact_latest,
    feature_freshness,
    materialize_view,
    online_lookup,
    read_latest,
    upsert_latest,
)
from chronofeat.plans.reports import (
    display_table,
    freshness_status,
    map_points,
    report_kpis,
    requested_stations,
    score_report,
    top_k,
)
from chronofeat.plans.views import LIVE_SERVICE, FeatureService, FeatureView
from chronofeat.sources.versions import RefreshedTable, current_version, publish, replace_table
from tests.conftest import MONDAY_NOON, rows_of

ROW = "k string, event_timestamp timestamp, v long"


def at(minutes):
    return MONDAY_NOON + timedelta(minutes=minutes)


def table(spark, rows, schema=ROW):
    return spark.createDataFrame([(k, None if m is None else at(m), *v) for k, m, *v in rows], schema)


def test_latest_breaks_ties_and_ignores_rows_without_time(spark):
    df = table(spark, [("a", 1, 5), ("a", 3, 2), ("a", 3, 9), ("b", 0, 1), ("c", None, 1)])
    assert rows_of(latest_per_key(df, ["k"], "event_timestamp").select("k", "v")) == [("a", 9), ("b", 1)]
    low = latest_per_key(df.withColumn("t", -F.col("v")), ["k"], "event_timestamp", ("t",))
    assert rows_of(low.select("k", "v")) == [("a", 2), ("b", 1)]


def test_latest_combines_before_the_shuffle(spark):
    plan = latest_per_key(table(spark, []), ["k"], "event_timestamp")._jdf.queryExecution()
    assert "partial_max" in plan.sparkPlan().toString()


def test_first_source_wins_per_key(spark):
    archive = table(spark, [("a", 0, 1), ("a", 60, 2)])
    recent = table(spark, [("a", 60, 9), ("a", 120, 3), ("b", 0, 4)])
    merged = merge_prefer_first([archive, recent], ["k", "event_timestamp"])
    assert rows_of(merged.select("k", "v")) == [("a", 1), ("a", 2), ("a", 3), ("b", 4)]


def test_weather_history_drops_the_future_and_newest_goes_to_the_topic(spark):
    schema = "region_id string, event_timestamp timestamp, temperature_c double, precipitation_mm double, wind_speed_kmh double"
    archive = table(spark, [("jc", 0, 1.0, 0.0, 0.0), ("jc", 120, 9.0, 0.0, 0.0)], schema)
    recent = table(spark, [("jc", 0, 5.0, 0.0, 0.0), ("jc", 60, 2.0, 0.0, 0.0)], schema)
    history = weather_history(archive, recent, at(90))
    assert rows_of(history.select("temperature_c")) == [(1.0,), (2.0,)]
    message = newest_observation(history).first()
    assert (message["event_ts_ms"], message["temperature_c"]) == (int(at(60).timestamp() * 1000), 2.0)


def test_dedupe_keeps_the_earliest_of_a_table(spark):
    df = table(spark, [("a", 5, 1), ("a", 2, 2), ("b", 1, 3)])
    got = dedupe_events(df, "k", "event_timestamp")
    assert rows_of(got.select("k", "v")) == [("a", 2), ("b", 3)]


def test_upserts_are_independent_of_order_and_repeats(spark, tmp_path):
    path = str(tmp_path / "latest")
    schema = table(spark, []).schema
    batches = [
        table(spark, [("a", 10, 1), ("b", 0, 1)]),
        table(spark, [("a", 5, 2), ("a", 20, 3), ("c", 0, 3)]),
        table(spark, [("a", 7, 4)]),
    ]
    for name in (1, 0, 2, 1, 0):
        upsert_latest(batches[name], path, ["k"], "event_timestamp", name)
    expected = [("a", 3), ("b", 1), ("c", 3)]
    read = read_latest(spark, path, schema, ["k"], "event_timestamp").select("k", "v")
    assert rows_of(read) == expected
    compact_latest(spark, path, schema, ["k"], "event_timestamp")
    assert current_version(spark, path)[0] == 1
    upsert_latest(batches[0], path, ["k"], "event_timestamp", 0)  # replayed after compaction
    again = read_latest(spark, path, schema, ["k"], "event_timestamp").select("k", "v")
    assert rows_of(again) == expected


def test_of_equal_times_the_last_write_counts(spark, tmp_path):
    """A correction may be smaller; it counts before and after compaction."""
    path, schema = str(tmp_path / "latest"), table(spark, []).schema
    read = lambda: rows_of(read_latest(spark, path, schema, ["k"], "event_timestamp").select("k", "v"))
    upsert_latest(table(spark, [("a", 10, 9), ("b", 10, 1)]), path, ["k"], "event_timestamp", 1)
    upsert_latest(table(spark, [("a", 10, 2)]), path, ["k"], "event_timestamp", 2)
    assert read() == [("a", 2), ("b", 1)]
    compact_latest(spark, path, schema, ["k"], "event_timestamp")
    upsert_latest(table(spark, [("b", 10, 0), ("a", 9, 7)]), path, ["k"], "event_timestamp", 3)
    assert read() == [("a", 2), ("b", 0)]
    upsert_latest(table(spark, [("a", 10, 5)]), path, ["k"], "event_timestamp", 4, order=1)
    assert read() == [("a", 2), ("b", 0)]  # an older write that comes late


def test_compaction_runs_beside_readers_and_writers(spark, tmp_path):
    path, schema = str(tmp_path / "latest"), table(spark, []).schema
    args = (schema, ["k"], "event_timestamp")
    assert read_latest(spark, path, *args).count() == 0
    upsert_latest(table(spark, [("a", 1, 1)]), path, ["k"], "event_timestamp", 0)
    reader = read_latest(spark, path, *args)  # has listed its files
    assert compact_latest(spark, path, *args) == 1
    assert rows_of(reader.select("k", "v")) == [("a", 1)]
    # A writer that had looked up version 0 before the switch.
    late = table(spark, [("a", 2, 2)]).withColumn("_written", F.lit(5).cast("long"))
    late.write.parquet(f"{path}/delta/version=0/batch=late")
    assert rows_of(read_latest(spark, path, *args).select("v")) == [(2,)]
    reader = read_latest(spark, path, *args)
    assert compact_latest(spark, path, *args) == 2
    assert rows_of(reader.select("v")) == rows_of(read_latest(spark, path, *args).select("v")) == [(2,)]
    for version in range(3, 7):
        upsert_latest(table(spark, [("b", version, version)]), path, ["k"], "event_timestamp", version)
        assert compact_latest(spark, path, *args) == version
    assert rows_of(read_latest(spark, path, *args).select("k", "v")) == [("a", 2), ("b", 6)]
    # What is kept does not grow: the base in force, the one before, and the batches of two versions.
    assert len(list((tmp_path / "latest" / "base").iterdir())) == 2
    assert len(list((tmp_path / "latest" / "delta").iterdir())) <= 2


def test_two_compactions_at_once_leave_one(spark, tmp_path, monkeypatch):
    path, schema = str(tmp_path / "latest"), table(spark, []).schema
    upsert_latest(table(spark, [("a", 1, 1)]), path, ["k"], "event_timestamp", 0)
    assert publish(spark, path, 1, "base/other")  # while ours is at work
    monkeypatch.setattr("chronofeat.plans.online.current_version", lambda s, p: (0, None))
    with pytest.raises(RuntimeError, match="someone else"):
        compact_latest(spark, path, schema, ["k"], "event_timestamp")
    assert list((tmp_path / "latest" / "base").iterdir()) == []


def test_a_refreshed_table_is_looked_up_again_after_its_age(spark, tmp_path):
    clock = [0.0]
    make = lambda v: table(spark, [("a", 0, v)])
    held = RefreshedTable(str(tmp_path), make(0).schema, timedelta(hours=1), lambda: clock[0])
    assert held.read(spark).count() == 0
    assert replace_table(make(1), str(tmp_path)) == 1
    assert held.read(spark).first()["v"] == 1  # nothing was held yet
    assert replace_table(make(2), str(tmp_path)) == 2
    clock[0] = 3600.0
    assert held.read(spark).first()["v"] == 1
    clock[0] = 3601.0
    assert held.read(spark).first()["v"] == 2
    for v in (3, 4):
        replace_table(make(v), str(tmp_path), keep=2)
    assert len(list((tmp_path / "rows").iterdir())) == 2


def test_materialisation_goes_on_from_the_last_run(spark, tmp_path):
    path = str(tmp_path / "profile")
    view = FeatureView("v", ("k",), ("v",), timedelta(hours=1))
    history = table(spark, [("a", 0, 1), ("b", -90, 2), ("a", 30, 3), ("a", 61, 4)])
    materialize_view(spark, view, history, path, at(0))
    read = lambda: rows_of(read_latest(spark, path, history.schema, ["k"], "event_timestamp").select("k", "v"))
    assert read() == [("a", 1)]  # b is past its lifetime already
    materialize_view(spark, view, history, path, at(60))
    assert read() == [("a", 3)]
    materialize_view(spark, view, history.where("false"), path, at(90))
    assert read() == [("a", 3)]


LIVE = "station_id string, event_timestamp timestamp, num_bikes_available long, num_ebikes_available long, num_docks_available long, is_renting long"


def live_lookup(spark):
    live = table(
        spark,
        [("A", -10, 3, 1, 9, 1), ("B", -11, 4, 1, 9, 1), ("C", None, 5, 1, 9, 1), ("E", -1, None, None, None, None)],
        LIVE,
    )
    asked = spark.createDataFrame([(s,) for s in "ABCDE"], "station_id string")
    return online_lookup(asked, LIVE_SERVICE, {"station_live_status": live}, at(0))


def test_values_are_blanked_only_past_their_lifetime(spark):
    got = {r["station_id"]: r for r in live_lookup(spark).collect()}
    assert got["A"]["num_bikes_available"] == 3  # exactly ten minutes old
    assert got["B"]["num_bikes_available"] is None and got["B"]["station_live_status__expired"]
    assert got["C"]["num_bikes_available"] == 5  # written without a time
    assert got["D"]["num_bikes_available"] is None and not got["D"]["station_live_status__expired"]


def test_freshness_counts_live_and_blanked(spark):
    row = feature_freshness(live_lookup(spark), LIVE_SERVICE, at(0)).first()
    # E is newer, but holds no value.
    assert tuple(row) == ("station_live_status", 600.0, 1)
    none = feature_freshness(live_lookup(spark).where("station_id = 'B'"), LIVE_SERVICE, at(0))
    assert tuple(none.first()) == ("station_live_status", None, 1)


def test_views_without_a_lifetime_are_never_blanked(spark):
    service = FeatureService("s", (FeatureView("v", ("k",), ("v",), None),))
    asked = spark.createDataFrame([("a",)], "k string")
    found = online_lookup(asked, service, {"v": table(spark, [("a", -(10**6), 1)])}, at(0))
    assert found.first()["v"] == 1


def test_freshness_states(spark):
    ages = spark.createDataFrame(
        [("station_recent_activity", 1800.0), ("station_live_status", 601.0), ("weather_hourly", None)],
        "view string, age_seconds double",
    )
    got = {r["view"]: (r["state"], r["age"]) for r in freshness_status(ages).collect()}
    assert got == {
        "station_recent_activity": ("fresh", "30 min old"),
        "station_live_status": ("stale", "10 min old"),
        "weather_hourly": ("no data yet", "no data"),
        "station_hourly_profile": ("no data yet", "no data"),
    }


def report(spark):
    scores = spark.createDataFrame(
        [("A", 2.675, 4, 1.5), ("B", -1.0, None, None), ("Z", 3.0, 1, 2.0)],
        "station_id string, prediction double, departures_1h long, avg_departures_4w double",
    )
    stations = spark.createDataFrame(
        [("A", "Main St", 40.0, -74.0), ("B", "", float("nan"), -74.5)],
        "station_id string, name string, lat double, lon double",
    )
    live = spark.createDataFrame(
        [("A", 2, 5, 1), ("B", 0, 1, 1), ("Z", None, None, None)],
        "station_id string, num_bikes_available long, num_docks_available long, is_renting long",
    )
    return score_report(scores, stations, live, ["departures_1h", "avg_departures_4w"])


def test_report_keeps_unknown_stations_and_flags_risk(spark):
    got = {r["station_id"]: r for r in report(spark).collect()}
    assert (got["A"]["predicted_departures_next_hour"], got["A"]["stockout_risk"]) == (2.68, True)
    assert (got["B"]["predicted_departures_next_hour"], got["B"]["lat"]) == (0.0, None)
    assert (got["Z"]["name"], got["Z"]["stockout_risk"]) == (None, False)  # bikes unknown
    assert got["A"]["features"].asDict() == {"departures_1h": 4, "avg_departures_4w": 1.5}


def test_of_several_station_rows_the_newest_counts(spark):
    scores = spark.createDataFrame([("A", 1.0)], "station_id string, prediction double")
    stations = spark.createDataFrame(
        [("A", "Zoo (closed)", 40.0, -74.0, 1), ("A", "Annex", 41.0, -73.0, 2)],
        "station_id string, name string, lat double, lon double, seen_at long",
    )
    live = spark.createDataFrame([], "station_id string, num_bikes_available long, num_docks_available long, is_renting long")
    row = score_report(scores, stations, live, ["prediction"], seen="seen_at").first()
    assert (row["name"], row["lat"]) == ("Annex", 41.0)


def test_display_top_kpis_and_map(spark):
    shown = display_table(report(spark))
    listed = shown.orderBy(shown["predicted"].desc()).collect()
    assert [(r["station"], r["risk"], r["departures_last_hour"]) for r in listed] == [
        ("Z", "ok", 1), ("Main St", "may run out", 4), ("B", "ok", 0),
    ]
    assert [r["station_id"] for r in top_k(shown, "predicted", "station_id", 2).collect()] == ["Z", "A"]
    kpis = report_kpis(shown).first()
    assert (kpis["stations"], kpis["at_risk"], kpis["centre_lat"]) == (3, 1, 40.0)
    assert kpis["expected_departures"] == pytest.approx(5.68)
    point = map_points(shown).collect()
    assert [(p["station_id"], p["color"], p["radius"]) for p in point] == [
        ("A", [208, 59, 59, 220], pytest.approx(25 + 18 * 2.68))
    ]


def test_all_stations_are_the_default_request(spark):
    stations = spark.createDataFrame([("A", 1), ("B", 2)], "station_id string, x int")
    assert rows_of(requested_stations(stations)) == [("A",), ("B",)]
    assert rows_of(requested_stations(stations, stations.where("x = 2"))) == [("B",)]
