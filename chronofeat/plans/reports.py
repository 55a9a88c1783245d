"""Scored stations, the ranked report, its key figures and the state of its inputs."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronofeat.functions.columns import age_label, clean_numeric

# Labels and age limits of the views, marker colours (RGBA) and radius.
FRESHNESS_LIMITS = {
    "station_recent_activity": ("Trip activity (stream)", timedelta(minutes=30)),
    "station_live_status": ("Bike availability (stream)", timedelta(minutes=10)),
    "weather_hourly": ("Weather (stream)", timedelta(hours=3)),
    "station_hourly_profile": ("Weekly profile (batch)", timedelta(days=90)),
}
RISK_COLOUR, SAFE_COLOUR = (208, 59, 59, 220), (42, 120, 214, 200)
BASE_RADIUS, RADIUS_PER_DEPARTURE = 25, 18
TOP_STATIONS = 15


def requested_stations(stations: DataFrame, requested: DataFrame | None = None) -> DataFrame:
    """The station ids asked for, each once; every known one if none is asked for."""
    if requested is None or requested.isEmpty():
        requested = stations
    return requested.select("station_id").distinct()


def _one_each(df: DataFrame, seen: str | None = None) -> DataFrame:
    """One row per station: the newest by `seen`, else the largest, whatever the order of rows."""
    rest = [c for c in df.columns if c not in ("station_id", seen)]
    lead = [F.col(seen)] if seen else []
    picked = df.groupBy("station_id").agg(F.max(F.struct(*lead, *rest)).alias("_row"))
    return picked.select("station_id", *[F.col(f"_row.{c}").alias(c) for c in rest])


def score_report(
    scores: DataFrame,
    stations: DataFrame,
    live: DataFrame | None,
    features: list[str],
    prediction: str = "prediction",
    seen: str | None = None,
) -> DataFrame:
    """One row per scored station with its place, live counts, risk and features.

    `scores` has a prediction and the feature columns per station; `live` has the live counts
    with lifetimes applied, or is None where these are columns of `scores`. A station missing from the station table keeps its row; of several
    rows of a station in `stations` the newest by its column `seen` is used, of several in `live` one.
    A missing prediction stays missing.
    """
    given = clean_numeric(F.col(prediction))
    expected = F.when(given.isNotNull(), F.round(F.greatest(given, F.lit(0.0)), 2))
    echo = F.struct(*[F.col(f).alias(f) for f in features])
    counts = {
        "bikes_available": F.col("num_bikes_available"),
        "docks_available": F.col("num_docks_available"),
        "is_renting": F.col("is_renting"),
    }
    named = [column.alias(name) for name, column in counts.items()]
    scored = scores.select(
        "station_id",
        expected.alias("predicted_departures_next_hour"),
        echo.alias("features"),
        *(named if live is None else []),
    )
    places = stations.select(
        "station_id", "name", clean_numeric(F.col("lat")).alias("lat"),
        clean_numeric(F.col("lon")).alias("lon"), *([seen] if seen else []),
    )
    short = F.col("predicted_departures_next_hour") > F.col("bikes_available")
    joined = scored.join(_one_each(places, seen), "station_id", "left")
    if live is not None:
        joined = joined.join(_one_each(live.select("station_id", *named)), "station_id", "left")
    return joined.select(
        "station_id",
        "name",
        "lat",
        "lon",
        "predicted_departures_next_hour",
        "bikes_available",
        "docks_available",
        "is_renting",
        F.coalesce(short, F.lit(False)).alias("stockout_risk"),
        "features",
    )


def display_table(report: DataFrame) -> DataFrame:
    """The report as people read it; sort it by `predicted`, descending, where it is shown."""
    has_name = F.col("name").isNotNull() & (F.col("name") != "")
    return report.select(
        F.when(has_name, F.col("name")).otherwise(F.col("station_id").cast("string")).alias("station"),
        "station_id",
        "lat",
        "lon",
        F.col("predicted_departures_next_hour").alias("predicted"),
        F.col("bikes_available").alias("bikes_now"),
        F.col("docks_available").alias("docks_now"),
        F.coalesce(F.col("features.departures_1h"), F.lit(0)).alias("departures_last_hour"),
        F.coalesce(F.col("features.avg_departures_4w"), F.lit(0.0)).alias("typical_for_hour"),
        F.when(F.col("stockout_risk"), "may run out").otherwise("ok").alias("risk"),
        F.col("stockout_risk").alias("at_risk"),
    )


def top_k(df: DataFrame, score: str, key: str, n: int = TOP_STATIONS) -> DataFrame:
    """The `n` rows of largest score, ties by key."""
    return df.orderBy(F.col(score).desc(), key).limit(n)


def report_kpis(display: DataFrame) -> DataFrame:
    """Number of stations, expected departures, stations at risk, and the map's centre."""
    return display.agg(
        F.count(F.lit(1)).alias("stations"),
        F.sum("predicted").alias("expected_departures"),
        F.count_if("at_risk").alias("at_risk"),
        F.avg("lat").alias("centre_lat"),
        F.avg("lon").alias("centre_lon"),
    )


def map_points(display: DataFrame) -> DataFrame:
    """Stations with a place: marker colour by risk, radius by prediction."""

    def colour(rgba: tuple[int, ...]):
        return F.array(*[F.lit(c) for c in rgba])

    return display.where(F.col("lat").isNotNull() & F.col("lon").isNotNull()).withColumns(
        {
            "color": F.when(F.col("at_risk"), colour(RISK_COLOUR)).otherwise(colour(SAFE_COLOUR)),
            "radius": BASE_RADIUS + RADIUS_PER_DEPARTURE * F.col("predicted"),
        }
    )


def freshness_status(
    ages: DataFrame, limits: dict[str, tuple[str, timedelta]] = FRESHNESS_LIMITS
) -> DataFrame:
    """State of each view in `limits`: fresh, stale past its limit, or without data.

    `limits` is a handful of views by definition, and `ages` has one row per view.
    """
    rows = [(view, label, limit.total_seconds()) for view, (label, limit) in limits.items()]
    known = ages.sparkSession.createDataFrame(rows, "view string, label string, limit_seconds double")
    age = F.col("age_seconds")
    state = F.when(age.isNull(), "no data yet").when(age > F.col("limit_seconds"), "stale")
    return known.join(ages.select("view", "age_seconds"), "view", "left").select(
        "view",
        "label",
        "age_seconds",
        state.otherwise("fresh").alias("state"),
        age_label(age).alias("age"),
    )
