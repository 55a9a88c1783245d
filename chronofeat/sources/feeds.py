"""Nested JSON snapshots of the live feeds, flattened to rows.

Each input row holds one document as text in `value`. Documents explode on the executors, so
any number of archived snapshots can be flattened in one job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronofeat.functions.columns import starts_with_any
from chronofeat.operators.latest import latest_per_key

# The parts of the feed documents that are read.
STATION_DOCUMENT = (
    "last_updated long, data struct<stations: array<struct<"
    "short_name: string, station_id: string, name: string, lat: double, lon: double>>>"
)
STATUS_COUNTS = (
    "num_bikes_available",
    "num_ebikes_available",
    "num_docks_available",
    "num_bikes_disabled",
    "num_docks_disabled",
    "is_renting",
    "is_returning",
)
STATUS_DOCUMENT = (
    "last_updated long, data struct<stations: array<struct<"
    "station_id: string, is_installed: long, "
    + ", ".join(f"{c}: long" for c in STATUS_COUNTS)
    + ">>>"
)
HOURLY_DOCUMENT = (
    "hourly struct<time: array<string>, temperature_2m: array<double>, "
    "precipitation: array<double>, wind_speed_10m: array<double>>"
)


def flatten_stations(
    docs: DataFrame,
    prefixes: tuple[str, ...] | None = None,
    keep: bool = True,
    stamp: str | None = None,
) -> DataFrame:
    """Stations that have a short name, which is the id the trip history uses.

    With `prefixes`, only ids starting with one of them (`keep`) or with none of them. `stamp` names
    a column for the time that the document gives itself, in seconds, 0 where it gives none.
    """
    record = docs.select(F.from_json("value", STATION_DOCUMENT).alias("d"))
    made = F.coalesce("d.last_updated", F.lit(0).cast("long")).alias("made")
    record = record.select(made, F.explode("d.data.stations").alias("s"))
    stations = record.where(F.col("s.short_name").isNotNull() & (F.col("s.short_name") != ""))
    stations = stations.select(
        F.col("s.short_name").alias("station_id"),
        F.col("s.station_id").alias("gbfs_station_id"),
        "s.name",
        "s.lat",
        "s.lon",
        *([F.col("made").alias(stamp)] if stamp else []),
    )
    if prefixes is None:
        return stations
    inside = starts_with_any(F.col("station_id"), prefixes)
    return stations.where(inside if keep else ~inside)


def newest_stations(
    docs: DataFrame, prefixes: tuple[str, ...] | None = None, keep: bool = True
) -> DataFrame:
    """`flatten_stations` with one row per station: the one of the newest document."""
    stations = flatten_stations(docs, prefixes, keep, stamp="_made")
    return latest_per_key(stations, ["station_id"], "_made").drop("_made")


def map_ids(df: DataFrame, id_map: DataFrame, on: str) -> DataFrame:
    """Replace a feed's own id by ours; rows of unknown ids go.

    No hint: adaptive execution broadcasts the map when its measured size allows it.
    """
    return df.join(id_map, on, "inner").drop(on)


def flatten_status(docs: DataFrame, id_map: DataFrame) -> DataFrame:
    """One row per known, installed station, stamped with the feed's own time.

    `id_map` holds `gbfs_station_id` and `station_id`. Missing counts are 0.
    """
    record = docs.select(F.from_json("value", STATUS_DOCUMENT).alias("d"))
    record = record.select(
        (F.col("d.last_updated") * 1000).alias("event_ts_ms"),
        F.explode("d.data.stations").alias("s"),
    ).where(F.coalesce(F.col("s.is_installed"), F.lit(0)) != 0)

    def count(name: str) -> Column:
        return F.coalesce(F.col(f"s.{name}"), F.lit(0).cast("long")).alias(name)

    rows = record.select(
        F.col("s.station_id").alias("gbfs_station_id"),
        "event_ts_ms",
        *[count(name) for name in STATUS_COUNTS],
    )
    ids = id_map.select("gbfs_station_id", "station_id")
    return map_ids(rows, ids, "gbfs_station_id").select(
        "station_id", "event_ts_ms", *STATUS_COUNTS
    )


def flatten_hourly(
    docs: DataFrame, region: Column | str, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Parallel arrays of hourly readings to one row per hour that has a temperature.

    The columns `keep` of a document go to each of its rows.
    """
    region = F.lit(region) if isinstance(region, str) else region
    parsed = F.from_json("value", HOURLY_DOCUMENT).alias("d")
    doc = docs.select(*keep, region.alias("region_id"), parsed)
    zipped = F.arrays_zip(
        "d.hourly.time", "d.hourly.temperature_2m", "d.hourly.precipitation",
        "d.hourly.wind_speed_10m",
    )
    rows = doc.select(*keep, "region_id", F.inline(zipped))
    rows = rows.where(F.col("temperature_2m").isNotNull())
    return rows.select(
        *keep,
        "region_id",
        F.try_to_timestamp("time").alias("event_timestamp"),
        F.col("temperature_2m").alias("temperature_c"),
        F.col("precipitation").alias("precipitation_mm"),
        F.col("wind_speed_10m").alias("wind_speed_kmh"),
    )
