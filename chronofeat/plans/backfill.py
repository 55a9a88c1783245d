"""The batch job: raw trips to events, and events to the feature and label tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronofeat.contracts import EVENTS, HOURLY_PROFILE, LABELS, RECENT_ACTIVITY, Contract
from chronofeat.operators.activity import activity_with_zeros
from chronofeat.operators.latest import latest_per_key, merge_prefer_first
from chronofeat.operators.seasonal import forward_label, seasonal_profile
from chronofeat.operators.trips import normalize_trips, observed_only, scope_filter, trip_events
from chronofeat.settings import Settings
from chronofeat.sources.periods import newest_month_paths
from chronofeat.sources.tables import read_feature_table, register_table, write_table
from chronofeat.sources.trips import read_trips


def events_from_raw(raw: DataFrame, settings: Settings) -> DataFrame:
    events = trip_events(normalize_trips(raw, settings.timezone))
    return scope_filter(events, settings.scope_prefixes, keep=settings.scope_is_prefixed)


def build_tables(events: DataFrame, settings: Settings) -> dict[str, DataFrame]:
    """The three tables made from events, by contract name."""
    return {
        RECENT_ACTIVITY.name: activity_with_zeros(events),
        HOURLY_PROFILE.name: seasonal_profile(events, settings.timezone),
        LABELS.name: forward_label(events),
    }


def run_backfill(spark: SparkSession, settings: Settings) -> dict[str, int]:
    """Write the event table and the tables made from it; returns rows written per table.

    Reads the newest months of raw trips, chosen by their folders' names. Events are written once
    and read back, so the three outputs share one pass over the raw text and nothing has to stay
    in executor memory. Every table can then be read by name.
    """
    months = newest_month_paths(spark, settings.table("raw", "trips"), settings.trip_months)
    raw = read_trips(spark, *months)

    def write(table: DataFrame, contract: Contract, folder: str) -> int:
        path = settings.table(folder, contract.name)
        rows = write_table(table, path, contract)
        register_table(spark, contract, path, f"{settings.database}.{contract.name}")
        return rows

    rows = {EVENTS.name: write(events_from_raw(raw, settings), EVENTS, "features")}
    events = read_feature_table(spark, EVENTS, settings.table("features", EVENTS.name))
    contracts = {c.name: c for c in (RECENT_ACTIVITY, HOURLY_PROFILE, LABELS)}
    for name, table in build_tables(events, settings).items():
        folder = "training" if name == LABELS.name else "features"
        rows[name] = write(table, contracts[name], folder)
    return rows


def weather_history(archive: DataFrame, recent: DataFrame, as_of: datetime) -> DataFrame:
    """Archive and recent readings as one history; the archive wins, the future goes."""
    merged = merge_prefer_first([archive, recent], ["region_id", "event_timestamp"])
    return observed_only(merged, "event_timestamp", as_of)


def newest_observation(readings: DataFrame) -> DataFrame:
    """The newest reading per region, as the message that the poll publishes."""
    newest = latest_per_key(readings, ["region_id"], "event_timestamp")
    return newest.select(
        "region_id",
        F.unix_millis("event_timestamp").alias("event_ts_ms"),
        "temperature_c",
        "precipitation_mm",
        "wind_speed_kmh",
    )
