from __future__ import annotations

import json
import os
import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from chronofeat.contracts import (
    EVENTS,
    LIVE_STATUS,
    RECENT_ACTIVITY,
    STATUS_MESSAGE,
    TRIP_MESSAGE,
    WEATHER_HOURLY,
    WEATHER_MESSAGE,
)
from chronofeat.operators import dedupe_events, only_changed, status_heartbeats, trailing_activity
from chronofeat.plans.online import read_latest
from chronofeat.settings import Settings
from chronofeat.sources import parse_messages, read_json_files_stream, replace_table
from chronofeat.streaming import (
    StreamQuery,
    activity_stream,
    changes_sink,
    compact_history,
    demand_queries,
    dropped_by_watermark,
    dual_sink,
    enrich_in_batch,
    history_sink,
    poll_queries,
    polling,
    read_history,
    start_pipeline,
)
from chronofeat.streaming.pipeline import trip_stream
from chronofeat.streaming.polling import station_ids
from tests.conftest import MONDAY_NOON, rows_of
from workload import tables as t
from workload.queries import QUERIES, activity_of_stream

NOW = {"availableNow": True}


def put(folder, number, records):
    """One input file per micro-batch; file times rise with their number."""
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / f"{number:04d}.json"
    path.write_text("\n".join(json.dumps(r) for r in records))
    os.utime(path, (1_700_000_000 + number, 1_700_000_000 + number))


def event(i, station, kind, minute):
    moment = MONDAY_NOON + timedelta(minutes=minute)
    return {"event_id": i, "station_id": station, "event_type": kind, "event_ts": moment.isoformat()}


def trip(i, station, kind, minute):
    ms = int((MONDAY_NOON + timedelta(minutes=minute)).timestamp() * 1000)
    return {"event_id": i, "ride_id": "r", "station_id": station, "event_type": kind, "event_ts_ms": ms}


def status(station, minute, bikes=5):
    ms = int((MONDAY_NOON + timedelta(minutes=minute)).timestamp() * 1000)
    return {"station_id": station, "event_ts_ms": ms, "num_bikes_available": bikes, "num_ebikes_available": 1,
            "num_docks_available": 9, "num_bikes_disabled": 0, "is_renting": 1, "is_returning": 1}


def run(rows, sink, tmp_path, name="q"):
    (query,) = start_pipeline([StreamQuery(name, rows, sink)], str(tmp_path / "checkpoints"), NOW)
    query.awaitTermination()
    return query


@pytest.mark.parametrize("prebucket", [False, True])
def test_stream_and_table_give_the_same_activity(spark, tmp_path, prebucket):
    pick = random.Random(8)
    records = [
        event(f"e{i}", f"S{pick.randrange(3)}", pick.choice(["departure", "arrival", "heartbeat"]), m)
        for i, m in enumerate(sorted(pick.randrange(400) for _ in range(120)))
    ]
    folder = tmp_path / "in"
    for n in range(6):
        batch = records[20 * n : 20 * n + 20]
        put(folder, n, batch + batch[:3])  # with redelivered copies
    for n, day in ((6, 1), (7, 2)):  # later events push every window past the watermark
        put(folder, n, [event(f"late{n}", "ZZ", "departure", 24 * 60 * day)])
    stream = dedupe_events(read_json_files_stream(spark, str(folder), EVENTS.schema))
    rows = trailing_activity(stream, prebucket=prebucket)
    run(rows, history_sink(str(tmp_path / "out")), tmp_path)
    got = read_history(spark, str(tmp_path / "out"), rows.schema).where("station_id <> 'ZZ'")
    table = spark.read.schema(EVENTS.schema).json(str(folder)).where("station_id <> 'ZZ'")
    expected = trailing_activity(dedupe_events(table))
    assert rows_of(got) == rows_of(expected)
    assert rows_of(got) != []


def test_the_stream_query_gives_every_window(spark):
    sf_dir = "/root/testdata/sf0.001"
    got = QUERIES["stream_trailing_activity"](spark, sf_dir)
    expected = QUERIES["trailing_activity"](spark, sf_dir)
    assert rows_of(got.select(*sorted(got.columns))) == rows_of(
        expected.select(*sorted(expected.columns))
    )


@pytest.mark.parametrize("files", [1, 6])
def test_the_stream_query_is_whole_in_many_batches(spark, tmp_path, files):
    """Events in six files, ordered by time: in one batch, and with a batch for each."""
    table = spark.read.schema(t.EVENTS_SCHEMA).parquet("/root/testdata/sf0.001/events.parquet")
    rows = sorted(table.collect(), key=lambda r: r["ts"])
    for n in range(6):
        part = rows[n * len(rows) // 6 : (n + 1) * len(rows) // 6]
        frame = spark.createDataFrame(part, table.schema).coalesce(1)
        frame.write.mode("append").parquet(f"{tmp_path}/events.parquet")
    assert QUERIES["trailing_activity"](spark, str(tmp_path)).count() > 0
    if files == 1:
        got = QUERIES["stream_trailing_activity"](spark, str(tmp_path))
    else:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        stream = spark.readStream.schema(t.EVENTS_SCHEMA).option("maxFilesPerTrigger", 1)
        stream = stream.parquet(f"{tmp_path}/events.parquet").select(
            "event_id", F.col("user_id").alias("station_id"), "event_type",
            F.col("ts").alias("event_ts"), F.floor("value").alias("num_bikes_available"),
        )
        last = t.events(spark, str(tmp_path)).agg(
            F.max("event_ts").alias("event_ts"), F.max("event_id").alias("event_id")
        )
        got = t.naive(activity_of_stream(stream, str(tmp_path / "home"), last))
        assert len(list((tmp_path / "home" / "checkpoint" / "activity" / "offsets").glob("[0-9]*"))) >= 7
    expected = QUERIES["trailing_activity"](spark, str(tmp_path))
    columns = sorted(got.columns)
    assert rows_of(got.select(*columns)) == rows_of(expected.select(*columns))


def stamped(rows):
    """(key, minute of arrival, id, minute of the stamp)"""
    make = lambda m: None if m is None else MONDAY_NOON + timedelta(minutes=m)
    return [(k, make(a), i, make(s)) for k, a, i, s in rows]


STAMPED = "k string, arrived timestamp, id long, stamp timestamp"


def test_a_stream_passes_on_only_what_has_changed(spark, tmp_path):
    """Over many batches as over the whole table, with nulls, ties and a hot key."""
    pick = random.Random(11)
    minutes = sorted(pick.randrange(4000) for _ in range(300))
    rows = stamped(
        [(pick.choice(["hot", "hot", "hot", "b", None]), m, i, pick.choice([None, 0, 60])) for i, m in enumerate(minutes)]
    )
    got = []
    sink = changes_sink(
        str(tmp_path / "state"), ["k"], "arrived", "stamp",
        lambda batch, n: got.extend(r["id"] for r in batch.collect()), ("id",),
    )
    for n in range(6):
        batch = spark.createDataFrame(rows[50 * n : 50 * n + 50], STAMPED)
        sink(batch, n)
        sink(batch, n)  # a batch that is repeated does nothing
    sink(spark.createDataFrame([], STAMPED), 6)
    whole = only_changed(spark.createDataFrame(rows, STAMPED).where("k IS NOT NULL"), ["k"], "arrived", "stamp", ("id",))
    keyed = {r[2] for r in rows if r[0] is not None}
    assert sorted(i for i in got if i in keyed) == sorted(r["id"] for r in whole.collect())
    assert len(list((tmp_path / "state" / "_done").glob("[0-9]*"))) == 2


def test_an_interrupted_batch_of_changes_is_done_again(spark, tmp_path):
    calls = []

    def sink(batch, n):
        calls.append(sorted(r["id"] for r in batch.collect()))
        if len(calls) == 2:
            raise OSError("disk full")

    changed = changes_sink(str(tmp_path / "state"), ["k"], "arrived", "stamp", sink)
    first = spark.createDataFrame(stamped([("a", 0, 1, 0), ("a", 1, 2, 0)]), STAMPED)
    second = spark.createDataFrame(stamped([("a", 2, 3, 0), ("a", 3, 4, 5)]), STAMPED)
    changed(first, 0)
    with pytest.raises(OSError):
        changed(second, 1)
    changed(second, 1)
    assert calls == [[1], [4], [4]]


def document(folder, number, doc, minute):
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / f"{number:04d}.json"
    path.write_text(json.dumps(doc, indent=1))
    moment = (MONDAY_NOON + timedelta(minutes=minute)).timestamp()
    os.utime(path, (moment, moment))


def test_polled_documents_become_messages(spark, tmp_path, monkeypatch):
    """Hours are passed on once; a station that the table learns of is known after its age."""
    settings = Settings(data_root=str(tmp_path / "data"), landing=str(tmp_path / "landing"))
    clock, out = [0.0], {"status": [], "weather": []}
    ids = station_ids(settings)
    ids.clock = lambda: clock[0]
    monkeypatch.setattr(polling, "station_ids", lambda settings: ids)
    sinks = [lambda b, n, to=out[k]: to.extend(b.collect()) for k in out]

    def known(*names):
        rows = [(f"u{n}", n) for n in names]
        replace_table(spark.createDataFrame(rows, "gbfs_station_id string, station_id string"), ids.path)

    def poll(number, minute, hours):
        places = [{"station_id": f"u{n}", "is_installed": 1, "num_bikes_available": number} for n in "AB"]
        document(tmp_path / "landing" / "status", number, {"last_updated": 60 * minute, "data": {"stations": places}}, minute)
        times = [(MONDAY_NOON + timedelta(hours=h)).strftime("%Y-%m-%dT%H:%M") for h in hours]
        reading = {"time": times, "temperature_2m": [float(h) for h in hours], "precipitation": [None] * len(hours), "wind_speed_10m": [1.0] * len(hours)}
        document(tmp_path / "landing" / "weather", number, {"hourly": reading}, minute)
        queries = poll_queries(spark, settings, *sinks)
        for query in start_pipeline(queries, str(tmp_path / "checkpoints"), NOW):
            query.awaitTermination()

    known("A")
    poll(0, 5, [-1, 0, 1])
    known("A", "B")
    clock[0] = 600.0
    poll(1, 15, [-1, 0, 1])
    clock[0] = 3700.0
    poll(2, 65, [0, 1, 2])
    assert [(m["station_id"], m["num_bikes_available"]) for m in out["status"][:2]] == [("A", 0), ("A", 1)]
    assert sorted((m["station_id"], m["num_bikes_available"]) for m in out["status"][2:]) == [("A", 2), ("B", 2)]
    assert [m["temperature_c"] for m in out["weather"]] == [0.0, 1.0]
    assert {m["region_id"] for m in out["weather"]} == {settings.region}


def test_unreadable_messages_can_be_kept(spark):
    texts = ['{"station_id": "S", "event_ts_ms": 5}', "no json", '{"station_id": "S"}']
    df = spark.createDataFrame([(x.encode(),) for x in texts], "value binary")
    assert parse_messages(df, STATUS_MESSAGE.schema).count() == 1
    kept = parse_messages(df, STATUS_MESSAGE.schema, unreadable="bad").collect()
    assert sorted(str(r["bad"]) for r in kept) == sorted(["None", *texts[1:]])


def test_memory_sink_holds_small_results(spark, tmp_path):
    put(tmp_path / "in", 0, [event("a", "S", "departure", 1)])
    stream = read_json_files_stream(spark, str(tmp_path / "in"), EVENTS.schema)
    query = stream.writeStream.format("memory").queryName("small").trigger(**NOW).start()
    query.awaitTermination()
    assert spark.table("small").count() == 1


def test_events_past_the_watermark_are_dropped_and_counted(spark, tmp_path):
    folder = tmp_path / "in"
    put(folder, 0, [event("a", "S", "departure", 0), event("b", "S", "departure", 300)])
    put(folder, 1, [event("c", "S", "departure", 301)])
    put(folder, 2, [event("late", "S", "departure", 10), event("d", "S", "departure", 900)])
    put(folder, 3, [event("e", "S", "departure", 2000)])
    rows = trailing_activity(dedupe_events(read_json_files_stream(spark, str(folder), EVENTS.schema)))
    query = run(rows, history_sink(str(tmp_path / "out")), tmp_path)
    assert dropped_by_watermark(query) >= 1
    got = read_history(spark, str(tmp_path / "out"), rows.schema)
    early = got.where(F.col("event_timestamp") <= F.lit(MONDAY_NOON + timedelta(minutes=120)))
    assert early.agg(F.max("departures_1h")).first()[0] == 1


def lagging_feeds(spark, tmp_path):
    """A status feed at its time, and a trip feed three hours behind it."""
    for n in range(5):
        put(tmp_path / "status", n, [status("S", 240 + 20 * n)])
        put(tmp_path / "trips", n, [trip(f"t{n}", "S", "departure", 60 + 20 * n)])
    put(tmp_path / "status", 5, [status("S", 5000)])
    put(tmp_path / "trips", 5, [trip("end", "S", "arrival", 5000)])
    trips = trip_stream(read_json_files_stream(spark, str(tmp_path / "trips"), TRIP_MESSAGE.schema))
    return trips, read_json_files_stream(spark, str(tmp_path / "status"), STATUS_MESSAGE.schema)


@pytest.mark.parametrize(("placement", "all_kept"), [("each", True), ("union", False)])
def test_watermark_placement_decides_about_a_lagging_feed(spark, tmp_path, placement, all_kept):
    trips, state = lagging_feeds(spark, tmp_path)
    rows = activity_stream(trips, state, watermark=placement)
    run(rows, history_sink(str(tmp_path / "out")), tmp_path, placement)
    got = read_history(spark, str(tmp_path / "out"), rows.schema)
    kept = got.agg(F.sum("departures_15m")).first()[0]
    assert (kept == 5) == all_kept


def test_live_heartbeats_give_quiet_stations_zero_rows(spark, tmp_path):
    for n in range(9):
        put(tmp_path / "status", n, [status("S", 15 * n), status("Q", 15 * n)])
    put(tmp_path / "status", 9, [status("ZZ", 5000)])
    put(tmp_path / "trips", 0, [trip("t", "S", "departure", 1)])
    trips = trip_stream(read_json_files_stream(spark, str(tmp_path / "trips"), TRIP_MESSAGE.schema))
    state = read_json_files_stream(spark, str(tmp_path / "status"), STATUS_MESSAGE.schema)
    rows = activity_stream(trips, state)
    run(rows, history_sink(str(tmp_path / "out")), tmp_path)
    got = read_history(spark, str(tmp_path / "out"), rows.schema).where("station_id = 'Q'")
    assert got.count() == 12
    assert got.agg(F.max(F.col("departures_1h") + F.col("arrivals_1h"))).first()[0] == 0
    with pytest.raises(ValueError, match="watermark"):
        activity_stream(trips, state, watermark="none")
    assert status_heartbeats(state).isStreaming


def test_a_repeated_batch_changes_nothing_and_an_empty_one_writes_nothing(spark, tmp_path):
    history, latest = str(tmp_path / "history"), str(tmp_path / "latest")
    sink = dual_sink(history, latest, ["k"], "ts")
    make = lambda n: spark.range(n).selectExpr("id % 2 AS k", "timestamp_seconds(id) AS ts")
    sink(make(0), 0)
    assert not (tmp_path / "history").exists()
    sink(make(5), 1)
    sink(make(3), 2)
    sink(make(5), 1)
    schema = make(0).schema
    assert read_history(spark, history, schema).count() == 8
    got = read_latest(spark, latest, schema, ["k"], "ts").selectExpr("k", "unix_seconds(ts)")
    assert rows_of(got) == [(0, 4), (1, 3)]
    compact_history(spark, history, str(tmp_path / "days"), schema, "ts")
    assert spark.read.parquet(str(tmp_path / "days")).count() == 8
    assert (tmp_path / "days" / "day=1970-01-01").exists()


def test_the_dimension_is_read_anew_in_every_batch(spark, tmp_path):
    ids = [("u1", "S1")]
    seen = []
    sink = enrich_in_batch(
        lambda s: s.createDataFrame(ids, "feed string, station_id string"),
        "feed",
        lambda batch, n: seen.append((n, rows_of(batch.select("station_id")))),
    )
    batch = spark.createDataFrame([("u1",), ("u2",)], "feed string")
    sink(batch, 0)
    ids.append(("u2", "S2"))
    sink(batch, 1)
    assert seen == [(0, [("S1",)]), (1, [("S1",), ("S2",)])]


def test_the_application_feeds_three_tables_and_restarts_from_its_checkpoints(spark, tmp_path):
    settings = Settings(data_root=str(tmp_path / "data"))

    def queries():
        return demand_queries(
            read_json_files_stream(spark, str(tmp_path / "trips"), TRIP_MESSAGE.schema),
            read_json_files_stream(spark, str(tmp_path / "status"), STATUS_MESSAGE.schema),
            read_json_files_stream(spark, str(tmp_path / "weather"), WEATHER_MESSAGE.schema),
            settings,
        )

    def play():
        for query in start_pipeline(queries(), settings.table("checkpoints"), NOW):
            query.awaitTermination()

    def newest(contract):
        path = settings.table("online", contract.name)
        return read_latest(spark, path, contract.schema, list(contract.keys), contract.ts)

    hour = {"region_id": "jc", "temperature_c": 20.0, "precipitation_mm": 0.0, "wind_speed_kmh": 1.0}
    put(tmp_path / "trips", 0, [trip("t", "S", "departure", 1)])
    put(tmp_path / "status", 0, [status("S", 0, 7), status("S", 1, 6)])
    put(tmp_path / "weather", 0, [hour | {"event_ts_ms": 0}])
    play()
    assert newest(LIVE_STATUS).first()["num_bikes_available"] == 6
    assert newest(WEATHER_HOURLY).first()["temperature_c"] == 20.0
    put(tmp_path / "status", 1, [status("S", 500, 1)])
    put(tmp_path / "weather", 1, [hour | {"event_ts_ms": 3_600_000, "temperature_c": 25.0}])
    play()
    assert newest(LIVE_STATUS).first()["num_bikes_available"] == 1
    assert newest(WEATHER_HOURLY).first()["temperature_c"] == 25.0
    history = read_history(spark, settings.table("features", LIVE_STATUS.name), LIVE_STATUS.schema)
    assert history.count() == 3  # nothing was read twice
    activity = read_history(spark, settings.table("stream_log", RECENT_ACTIVITY.name), RECENT_ACTIVITY.schema)
    assert activity.agg(F.max("departures_1h")).first()[0] == 1
    assert newest(RECENT_ACTIVITY).where("station_id = 'S'").count() == 1
