from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from chronofeat.contracts import TRIP_MESSAGE, WEATHER_MESSAGE
from chronofeat.sources import (
    flatten_hourly,
    flatten_stations,
    flatten_status,
    kafka_options,
    map_ids,
    parse_messages,
    to_envelope,
)
from chronofeat.sources.feeds import STATUS_COUNTS, newest_stations
from tests.conftest import rows_of


def docs(spark, *documents):
    return spark.createDataFrame([(json.dumps(d),) for d in documents], "value string")


def test_stations_need_a_short_name_and_may_be_scoped(spark):
    record = {"station_id": "u1", "name": "N", "lat": 40.5, "lon": -74, "capacity": 3}
    doc = {"data": {"stations": [record | {"short_name": s} for s in ("JC1", "5400.1", "", None)] + [record]}}
    got = rows_of(flatten_stations(docs(spark, doc)))
    assert got == [("5400.1", "u1", "N", 40.5, -74.0), ("JC1", "u1", "N", 40.5, -74.0)]
    assert rows_of(flatten_stations(docs(spark, doc), ("JC",)).select("station_id")) == [("JC1",)]
    assert rows_of(flatten_stations(docs(spark, doc), ("JC",), keep=False).select("station_id")) == [("5400.1",)]


def test_status_is_for_known_installed_stations_at_the_feeds_time(spark):
    doc = {
        "last_updated": 1700000000,
        "data": {
            "stations": [
                {"station_id": "u1", "is_installed": 1, "num_bikes_available": 4},
                {"station_id": "u1", "is_installed": 0},
                {"station_id": "u1"},
                {"station_id": "unknown", "is_installed": 1},
            ]
        },
    }
    ids = spark.createDataFrame([("u1", "JC1")], "gbfs_station_id string, station_id string")
    got = flatten_status(docs(spark, doc, doc), ids)
    assert got.columns == ["station_id", "event_ts_ms", *STATUS_COUNTS]
    assert rows_of(got) == [("JC1", 1700000000000, 4, 0, 0, 0, 0, 0, 0)] * 2


def test_parallel_arrays_become_rows(spark):
    doc = {
        "hourly": {
            "time": ["2026-08-03T00:00", "2026-08-03T01:00", "2026-08-03T02:00"],
            "temperature_2m": [20.5, None, 19],
            "precipitation": [0, 1, None],
            "wind_speed_10m": [3, 4, 5],
        }
    }
    got = flatten_hourly(docs(spark, doc), "jc").withColumn("event_timestamp", F.col("event_timestamp").cast("string"))
    assert rows_of(got) == [
        ("jc", "2026-08-03 00:00:00", 20.5, 0.0, 3.0),
        ("jc", "2026-08-03 02:00:00", 19.0, None, 5.0),
    ]


def test_unreadable_messages_and_unknown_fields_go(spark):
    good = {"event_id": "e", "ride_id": "r", "event_type": "arrival", "station_id": "S", "event_ts_ms": 5}
    df = spark.createDataFrame(
        [(json.dumps(good).encode(),), (b"not json",), (b'{"event_id": "x"}',), (b'{"event_ts_ms": "soon"}',)],
        "value binary",
    )
    parsed = parse_messages(df, TRIP_MESSAGE.schema)
    assert rows_of(parsed) == [("e", "S", "arrival", 5)]


def test_envelopes_keep_nulls_and_read_back(spark):
    rows = spark.createDataFrame([("jc", 5, 20.5, None, 1.0)], WEATHER_MESSAGE.schema)
    envelope = to_envelope(rows, "region_id")
    key, value = envelope.first()
    assert key == "jc"
    assert json.loads(value) == {"region_id": "jc", "event_ts_ms": 5, "temperature_c": 20.5, "precipitation_mm": None, "wind_speed_kmh": 1.0}
    assert rows_of(parse_messages(envelope, WEATHER_MESSAGE.schema)) == rows_of(rows)


def test_ids_map_to_ours(spark):
    feed = spark.createDataFrame([("u1", 1), ("u2", 2)], "feed string, n int")
    ids = spark.createDataFrame([("u1", "S1")], "feed string, station_id string")
    assert rows_of(map_ids(feed, ids, "feed")) == [(1, "S1")]


def test_kafka_options():
    assert kafka_options("h:1") == {"kafka.bootstrap.servers": "h:1"}
    iam = kafka_options("h:1", "msk_iam")
    assert iam["kafka.security.protocol"] == "SASL_SSL" and iam["kafka.sasl.mechanism"] == "AWS_MSK_IAM"
    with pytest.raises(ValueError, match="unknown kafka auth"):
        kafka_options("h:1", "basic")


def test_newest_station_documents_win(spark):
    def doc(made, *places):
        rows = [{"short_name": s, "station_id": f"u{s}", "name": n, "lat": 1.0, "lon": 2.0} for s, n in places]
        return (json.dumps({"last_updated": made, "data": {"stations": rows}}),)

    docs = [doc(5, ("A", "new"), ("B", "b")), doc(3, ("A", "old"), ("C", "c")), doc(None, ("C", "undated"))]
    got = newest_stations(spark.createDataFrame(docs, "value string"))
    assert rows_of(got.select("station_id", "name")) == [("A", "new"), ("B", "b"), ("C", "c")]
