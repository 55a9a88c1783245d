from __future__ import annotations

from datetime import datetime

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from chronofeat.operators.changes import only_changed
from chronofeat.plans.reports import requested_stations, score_report
from chronofeat.plans.training import capped_split


def tables(spark, predictions):
    scores = spark.createDataFrame(predictions, "station_id string, prediction double")
    scores = scores.withColumns({"departures_1h": F.lit(1), "avg_departures_4w": F.lit(2.0)})
    places = [("A", "old", 1.0, 2.0), ("A", "older", 1.0, 2.0), ("B", "b", float("nan"), None)]
    stations = spark.createDataFrame(
        places, "station_id string, name string, lat double, lon double"
    )
    live = spark.createDataFrame(
        [("A", 3, 4, 1), ("A", 2, 5, 1)],
        "station_id string, num_bikes_available int, num_docks_available int, is_renting int",
    )
    return scores, stations, live


def test_repeated_station_rows_do_not_multiply(spark):
    report = score_report(*tables(spark, [("A", 4.0), ("B", 1.0)]), ["departures_1h"])
    got = rows_of(report.select("station_id", "name", "lat", "bikes_available"))
    assert got == [("A", "older", 1.0, 3), ("B", "b", None, None)]


@pytest.mark.parametrize("given, shown", [(None, None), (float("nan"), None), (-1.0, 0.0)])
def test_a_missing_prediction_stays_missing(spark, given, shown):
    report = score_report(*tables(spark, [("A", given)]), ["departures_1h"])
    row = report.first()
    assert (row["predicted_departures_next_hour"], row["stockout_risk"]) == (shown, False)


def test_requests_are_distinct_and_never_empty(spark):
    _, stations, _ = tables(spark, [("A", 1.0)])
    twice = stations.where("station_id = 'A'")
    assert rows_of(requested_stations(stations, twice)) == [("A",)]
    assert rows_of(requested_stations(stations, twice.limit(0))) == [("A",), ("B",)]


def test_ties_in_arrival_do_not_depend_on_the_input_order(spark):
    at = datetime(2026, 8, 3, 12)
    rows = [("k", at, 1, "a"), ("k", at, 2, "b"), ("k", at, 1, "c")]
    found = [
        rows_of(
            only_changed(
                spark.createDataFrame(order, "k string, at timestamp, stamp int, note string"),
                ["k"], "at", "stamp",
            ).select("stamp", "note")
        )
        for order in (rows, rows[::-1], [rows[1], rows[0], rows[2]])
    ]
    assert found == [[(1, "a"), (2, "b")]] * 3


def test_the_cap_leaves_held_out_rows_alone(spark):
    labels = spark.range(1000).select(
        F.timestamp_seconds(F.col("id") * 60).alias("event_timestamp"), F.col("id").alias("y")
    )
    split = capped_split(labels, 50)
    counts = dict(map(tuple, split.groupBy("is_validation").count().collect()))
    assert counts == {False: 50, True: 200}
