"""The whole chain on a small deployment: raw files to a scored report."""

from __future__ import annotations

import json
import random
from dataclasses import replace
from datetime import UTC, datetime, timedelta
from pathlib import Path

import pytest

from chronofeat.contracts import LIVE_STATUS, RECENT_ACTIVITY
from chronofeat.plans import runs
from chronofeat.plans.backfill import run_backfill
from chronofeat.plans.online import read_latest, upsert_latest
from chronofeat.plans.replay import ReplayCursor, data_span, local_events, replay, replay_slices
from chronofeat.settings import Settings
from chronofeat.sources import in_time_order, read_feature_table, read_trips, write_json_folder

START = datetime(2026, 7, 1)
AS_OF = datetime(2026, 7, 14, 12, tzinfo=UTC)


@pytest.fixture(scope="module")
def deployment(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("deployment")
    settings = Settings(data_root=str(root))
    pick = random.Random(6)
    lines = ["ride_id,started_at,ended_at,start_station_id,end_station_id"]
    for i in range(3000):
        start = START + timedelta(minutes=pick.randrange(14 * 24 * 60))
        end = start + timedelta(minutes=pick.randrange(3, 40))
        lines.append(f"r{i},{start},{end},JC{pick.randrange(3)},HB{pick.randrange(2)}")
    month = root / "raw" / "trips" / "202607"
    month.mkdir(parents=True)
    (month / "t.csv").write_text("\n".join(lines) + "\n")
    run_backfill(spark, settings)

    places = [
        {"short_name": s, "station_id": f"u{s}", "name": f"Name {s}", "lat": 40.0, "lon": -74.0}
        for s in ("JC0", "JC1", "JC2", "6140.05")
    ]
    (root / "stations.json").write_text(json.dumps({"data": {"stations": places}}))
    assert runs.load_stations(spark, settings, str(root / "stations.json")) == 3

    hours = [START + timedelta(hours=h) for h in range(24 * 15)]
    doc = {"hourly": {"time": [f"{h:%Y-%m-%dT%H:%M}" for h in hours], "temperature_2m": [20.0] * len(hours),
                      "precipitation": [0.0] * len(hours), "wind_speed_10m": [5.0] * len(hours)}}
    for name in ("archive", "recent"):
        (root / f"{name}.json").write_text(json.dumps(doc))
    runs.load_weather(spark, settings, str(root / "archive.json"), str(root / "recent.json"), AS_OF)

    live = spark.createDataFrame([("JC0", AS_OF - timedelta(minutes=5), 0, 0, 9, 1)], LIVE_STATUS.schema)
    upsert_latest(live, settings.table("online", LIVE_STATUS.name), ["station_id"], "event_timestamp", 0)
    activity = read_feature_table(spark, RECENT_ACTIVITY, settings.table("features", RECENT_ACTIVITY.name))
    upsert_latest(activity.where(activity.event_timestamp <= AS_OF), settings.table("online", RECENT_ACTIVITY.name), ["station_id"], "event_timestamp", 0)
    return settings


def test_training_materialising_and_scoring(spark, deployment):
    record = runs.run_training(spark, deployment, AS_OF, "glm", cap=5000)
    assert record["rows"]["train"] <= 5000  # held-out rows are not capped
    assert set(record["metrics"]) == {"model", "baseline_profile", "baseline_last_hour"}
    runs.run_materialize(spark, deployment, AS_OF)
    report, ages = runs.run_scoring(spark, deployment, AS_OF)
    got = {r["station_id"]: r for r in report.collect()}
    assert set(got) == {"JC0", "JC1", "JC2"}
    assert got["JC0"]["stockout_risk"] and got["JC1"]["bikes_available"] is None
    assert got["JC1"]["features"]["temperature_c"] == 20.0
    assert got["JC1"]["features"]["avg_departures_4w"] is not None
    age = {r["view"]: r["age_seconds"] for r in ages.collect()}
    assert age["station_live_status"] == 300.0 and age["weather_hourly"] == 0.0
    one, _ = runs.run_scoring(spark, deployment, AS_OF, report.where("station_id = 'JC2'"))
    assert [r["station_id"] for r in one.collect()] == ["JC2"]


def test_replaying_the_newest_month(spark, deployment):
    events = local_events(read_trips(spark, deployment.table("raw", "trips", "*", "*.csv")))
    _, last = data_span(events)
    as_of = datetime(2026, 9, 10, 12, tzinfo=UTC)
    messages = runs.replay_messages(spark, deployment, as_of).collect()
    assert messages and all(as_of - timedelta(minutes=75) < datetime.fromtimestamp(m["event_ts_ms"] / 1000, UTC) <= as_of for m in messages)
    weeks = {int(m["event_id"].split(":")[2]) for m in messages}
    assert len(weeks) == 1 and last + timedelta(weeks=weeks.pop()) >= as_of.replace(tzinfo=None) - timedelta(hours=4)


def sent(folder):
    """Messages by slice, in the order of their files' lines."""
    out = {}
    for path in sorted(folder.glob("slice=*/part-*.json")):
        lines = [json.loads(line) for line in path.read_text().splitlines()]
        times = [m["event_ts_ms"] for m in lines]
        assert times == sorted(times)  # each file is in the order of time
        out.setdefault(path.parent.name, []).extend(lines)
    return out


def test_replaying_goes_on_from_the_cursor_and_across_a_step_up(spark, deployment, tmp_path):
    """Every moment is replayed once, whatever the runs; the shift steps up on the way."""
    settings = replace(deployment, data_root=str(tmp_path))
    (tmp_path / "raw").symlink_to(Path(deployment.data_root) / "raw")
    folder = tmp_path / "sent"

    def send(messages, number):
        write_json_folder(messages, f"{folder}/slice={number:010d}", "station_id")

    start = datetime(2026, 9, 7, 12, tzinfo=UTC)
    whole = timedelta(days=5)
    ends = [start + whole / 3, start + whole / 3, start + 2 * whole / 3, start + whole]
    numbers = [runs.run_replaying(spark, settings, end, send, start) for end in ends]
    assert numbers[1] == 0 and sum(numbers) == 4  # three runs had work, one of them two slices
    got = sorted(m["event_id"] for part in sent(folder).values() for m in part)
    assert len(got) == len(set(got))
    assert {int(i.split(":")[2]) for i in got} == {8, 9}
    events = runs.replay_events(spark, settings)
    _, last = data_span(events)
    pieces = replay_slices(last, settings.timezone, start, start + whole)
    wanted = [
        r["event_id"]
        for low, high, weeks in pieces
        for r in replay(events, settings.timezone, low, high, weeks).collect()
    ]
    assert got == sorted(wanted)
    assert runs.run_replaying(spark, settings, start, send) == 0  # the clock went back


def test_an_interrupted_slice_is_sent_again_under_its_number(spark, deployment, tmp_path):
    settings = replace(deployment, data_root=str(tmp_path))
    (tmp_path / "raw").symlink_to(Path(deployment.data_root) / "raw")
    seen = []

    def broken(messages, number):
        seen.append(number)
        raise OSError("no broker")

    as_of = datetime(2026, 9, 10, 12, tzinfo=UTC)
    with pytest.raises(OSError):
        runs.run_replaying(spark, settings, as_of, broken)
    assert runs.run_replaying(spark, settings, as_of, lambda m, n: seen.append(n)) == 1
    assert seen == [1, 1]
    cursor = ReplayCursor(spark, settings.table("checkpoints", "replay"))
    assert cursor.read() == (1, as_of)
    with pytest.raises(RuntimeError, match="another run"):
        cursor.commit(1, as_of)


def test_a_replay_reads_one_month(spark, deployment, tmp_path):
    settings = replace(deployment, data_root=str(tmp_path))
    for month in ("202606", "202607"):
        (tmp_path / "raw" / "trips").mkdir(parents=True, exist_ok=True)
        source = Path(deployment.data_root) / "raw" / "trips" / "202607"
        (tmp_path / "raw" / "trips" / month).symlink_to(source)
    files = runs.replay_events(spark, settings).inputFiles()
    assert [f.split("/")[-2] for f in files] == ["202607"]


def test_messages_of_a_key_are_in_order_within_each_file(spark, tmp_path):
    pick = random.Random(3)
    rows = [(f"m{i}", pick.choice(["hot", "hot", "b"]), pick.randrange(50)) for i in range(5000)]
    df = spark.createDataFrame(rows, "event_id string, station_id string, event_ts_ms long")
    write_json_folder(df.repartition(7), f"{tmp_path}/slice=1", "station_id")
    got = sent(tmp_path)["slice=1"]
    assert sorted(m["event_id"] for m in got) == sorted(r[0] for r in rows)
    assert len(list((tmp_path / "slice=1").glob("part-*.json"))) > 1
    text = in_time_order(df, "station_id")._jdf.queryExecution().sparkPlan().toString()
    assert "rangepartitioning(event_ts_ms" in text


def test_compaction_of_the_deployment(spark, deployment):
    runs.run_materialize(spark, deployment, AS_OF)
    path = deployment.table("online", LIVE_STATUS.name)
    read = lambda: read_latest(spark, path, LIVE_STATUS.schema, ["station_id"], "event_timestamp")
    rows = sorted(map(tuple, read().collect()))
    versions = runs.run_compaction(spark, deployment)
    assert versions[LIVE_STATUS.name] >= 1 and RECENT_ACTIVITY.name in versions
    assert sorted(map(tuple, read().collect())) == rows
