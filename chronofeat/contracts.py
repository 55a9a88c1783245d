"""Declared schemas: one place that drives readers, table DDL and conformance checks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
}


def schema_of(**columns: str) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in columns.items()])


class ContractError(ValueError):
    """A table does not have the columns its contract declares."""


@dataclass(frozen=True)
class Contract:
    name: str
    schema: T.StructType
    keys: tuple[str, ...] = ()
    ts: str | None = None

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def values(self) -> list[str]:
        return [c for c in self.columns if c not in self.keys and c != self.ts]


def check_contract(df: DataFrame, contract: Contract) -> DataFrame:
    """`df` in the contract's column order, or `ContractError` before any job runs."""
    have = {f.name: f.dataType for f in df.schema}
    want = {f.name: f.dataType for f in contract.schema}
    faults = [f"missing {name}" for name in want if name not in have]
    faults += [f"unexpected {name}" for name in have if name not in want]
    faults += [
        f"{name} is {have[name].simpleString()}, not {kind.simpleString()}"
        for name, kind in want.items()
        if name in have and have[name] != kind
    ]
    if faults:
        raise ContractError(f"{contract.name}: " + "; ".join(faults))
    return df.select(*contract.columns)


# Column names and types of the tables and messages.
RAW_TRIPS = Contract(
    "raw_trips",
    schema_of(
        ride_id="string",
        started_at="string",
        ended_at="string",
        start_station_id="string",
        end_station_id="string",
    ),
    keys=("ride_id",),
)
STATIONS = Contract(
    "stations",
    schema_of(
        station_id="string", gbfs_station_id="string", name="string", lat="double", lon="double"
    ),
    keys=("station_id",),
)
STATION_IDS = Contract(
    "station_ids",
    schema_of(gbfs_station_id="string", station_id="string"),
    keys=("gbfs_station_id",),
)
EVENTS = Contract(
    "events",
    schema_of(event_id="string", station_id="string", event_type="string", event_ts="timestamp"),
    keys=("station_id",),
    ts="event_ts",
)
TRIP_MESSAGE = Contract(
    "trip_message",
    schema_of(event_id="string", station_id="string", event_type="string", event_ts_ms="long"),
    keys=("station_id",),
    ts="event_ts_ms",
)
STATUS_MESSAGE = Contract(
    "status_message",
    schema_of(
        station_id="string",
        event_ts_ms="long",
        num_bikes_available="long",
        num_ebikes_available="long",
        num_docks_available="long",
        is_renting="long",
    ),
    keys=("station_id",),
    ts="event_ts_ms",
)
WEATHER_MESSAGE = Contract(
    "weather_message",
    schema_of(
        region_id="string",
        event_ts_ms="long",
        temperature_c="double",
        precipitation_mm="double",
        wind_speed_kmh="double",
    ),
    keys=("region_id",),
    ts="event_ts_ms",
)
RECENT_ACTIVITY = Contract(
    "station_recent_activity",
    schema_of(
        station_id="string",
        event_timestamp="timestamp",
        departures_15m="long",
        departures_1h="long",
        arrivals_15m="long",
        arrivals_1h="long",
    ),
    keys=("station_id",),
    ts="event_timestamp",
)
HOURLY_PROFILE = Contract(
    "station_hourly_profile",
    schema_of(
        station_id="string",
        hour_of_week="long",
        event_timestamp="timestamp",
        avg_departures_4w="double",
        avg_arrivals_4w="double",
    ),
    keys=("station_id", "hour_of_week"),
    ts="event_timestamp",
)
LIVE_STATUS = Contract(
    "station_live_status",
    schema_of(
        station_id="string",
        event_timestamp="timestamp",
        num_bikes_available="long",
        num_ebikes_available="long",
        num_docks_available="long",
        is_renting="long",
    ),
    keys=("station_id",),
    ts="event_timestamp",
)
WEATHER_HOURLY = Contract(
    "weather_hourly",
    schema_of(
        region_id="string",
        event_timestamp="timestamp",
        temperature_c="double",
        precipitation_mm="double",
        wind_speed_kmh="double",
    ),
    keys=("region_id",),
    ts="event_timestamp",
)
LABELS = Contract(
    "labels",
    schema_of(
        station_id="string", event_timestamp="timestamp", target_departures_next_1h="long"
    ),
    keys=("station_id",),
    ts="event_timestamp",
)
FEATURE_TABLES = (RECENT_ACTIVITY, HOURLY_PROFILE, LIVE_STATUS, WEATHER_HOURLY, LABELS)
