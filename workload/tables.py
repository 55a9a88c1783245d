"""The given tables in the shape of the domain tables (see FIXTURES.md, section 3)."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronofeat.functions.timekit import HOUR, bucket_start, hour_of_week
from chronofeat.operators.activity import activity_with_zeros
from chronofeat.operators.seasonal import forward_label, seasonal_profile
from chronofeat.plans.views import FeatureService, FeatureView
from chronofeat.functions.columns import net_flow

TZ = "America/New_York"
AS_OF = datetime(2024, 1, 20, 12, tzinfo=UTC)
KINDS = {"departures": "click", "arrivals": "view"}

EVENTS_SCHEMA = (
    "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
)
ORDERS_SCHEMA = "o_orderkey long, o_custkey long, o_orderdate timestamp"
LINEITEM_SCHEMA = (
    "l_orderkey long, l_suppkey long, l_linenumber int, l_quantity double, l_discount double,"
    " l_returnflag string, l_shipdate timestamp"
)
CUSTOMER_SCHEMA = "c_custkey long, c_name string, c_nationkey int, c_acctbal double"
SUPPLIER_SCHEMA = "s_suppkey long, s_name string, s_nationkey int"


def scan(spark: SparkSession, sf_dir: str, table: str, schema: str) -> DataFrame:
    """A table under a declared schema: naive stored times are read as UTC instants, so time
    filters still reach the Parquet scan."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.schema(schema).parquet(f"{sf_dir}/{table}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark, sf_dir, "events", EVENTS_SCHEMA).select(
        "event_id",
        F.col("user_id").alias("station_id"),
        "event_type",
        F.col("ts").alias("event_ts"),
        "value",
        "props",
    )


def bare_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select("event_id", "station_id", "event_type", "event_ts")


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as trips with times as text; an undiscounted item has an unreadable end."""
    wall = "yyyy-MM-dd HH:mm:ss"
    orders = scan(spark, sf_dir, "orders", ORDERS_SCHEMA)
    items = scan(spark, sf_dir, "lineitem", LINEITEM_SCHEMA)
    ended = F.when(F.col("l_discount") == 0, "unknown").otherwise(F.date_format("l_shipdate", wall))
    return items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("ride_id"),
        F.date_format("o_orderdate", wall).alias("started_at"),
        ended.alias("ended_at"),
        F.concat(F.lit("C"), "o_custkey").alias("start_station_id"),
        F.concat(F.lit("S"), "l_suppkey").alias("end_station_id"),
    )


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as stations: every seventh nation has no place, and one segment no name."""
    place = F.col("c_nationkey") % 7 != 0
    return scan(spark, sf_dir, "customer", CUSTOMER_SCHEMA).select(
        F.col("c_custkey").alias("station_id"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_name")).alias("name"),
        F.when(place, 40 + F.col("c_nationkey") / 64).alias("lat"),
        F.when(place, -74 - F.col("c_nationkey") / 128).alias("lon"),
    )


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly readings of five regions; order-free aggregates of the events."""
    ev = events(spark, sf_dir)
    return weather_of(ev, F.max("value"))


def weather_of(ev: DataFrame, temperature: Column) -> DataFrame:
    return ev.groupBy(
        (F.col("station_id") % 5).alias("region_id"),
        bucket_start(F.col("event_ts"), HOUR).alias("event_timestamp"),
    ).agg(
        temperature.alias("temperature_c"),
        F.min("value").alias("precipitation_mm"),
        F.max(F.col("value") * 2).alias("wind_speed_kmh"),
    )


def status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sign-ups as live status readings."""
    bikes = F.floor("value")
    return (
        events(spark, sf_dir)
        .where(F.col("event_type") == "signup")
        .select(
            "station_id",
            F.col("event_ts").alias("event_timestamp"),
            bikes.alias("num_bikes_available"),
            F.floor(bikes / 4).alias("num_ebikes_available"),
            (400 - bikes).alias("num_docks_available"),
            F.when(bikes % 3 == 0, F.lit(None)).otherwise(1).cast("long").alias("is_renting"),
        )
    )


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity_with_zeros(bare_events(spark, sf_dir), kinds=KINDS)


def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seasonal_profile(bare_events(spark, sf_dir), TZ, kinds=KINDS)


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forward_label(bare_events(spark, sf_dir), counted="click")


def keyed_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels(spark, sf_dir).withColumns(
        {
            "hour_of_week": hour_of_week(F.col("event_timestamp"), TZ),
            "region_id": F.col("station_id") % 5,
        }
    )


ACTIVITY = FeatureView(
    "station_recent_activity",
    ("station_id",),
    ("departures_15m", "departures_1h", "arrivals_15m", "arrivals_1h"),
    timedelta(minutes=30),
)
PROFILE = FeatureView(
    "station_hourly_profile",
    ("station_id", "hour_of_week"),
    ("avg_departures_4w", "avg_arrivals_4w"),
    timedelta(days=90),
    bucket=None,
    strategy="interval",
)
WEATHER = FeatureView(
    "weather_hourly",
    ("region_id",),
    ("temperature_c", "precipitation_mm", "wind_speed_kmh"),
    timedelta(hours=3),
    bucket=HOUR,
    strategy="interval",
)
# The stand-in readings are far apart, so their lifetime is days and not minutes.
STATUS = FeatureView(
    "station_live_status",
    ("station_id",),
    ("num_bikes_available", "num_ebikes_available", "num_docks_available", "is_renting"),
    timedelta(days=2),
)
SERVICE = FeatureService(
    "demand",
    (ACTIVITY, PROFILE, WEATHER),
    {"typical_net_flow_4w": lambda: net_flow(F.col("avg_arrivals_4w"), F.col("avg_departures_4w"))},
)
LIVE = FeatureService("live", (STATUS,))


def naive(df: DataFrame) -> DataFrame:
    """Timestamps as naive UTC, the type the SQL engine gives them."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz") if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
            for f in df.schema
        ]
    )
