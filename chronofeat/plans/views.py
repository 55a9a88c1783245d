"""Feature views and services: which columns belong to which keys, and how long they hold."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from chronofeat.contracts import HOURLY_PROFILE, LIVE_STATUS, RECENT_ACTIVITY, WEATHER_HOURLY
from chronofeat.functions.columns import net_flow

DAY = timedelta(days=1)


@dataclass(frozen=True)
class FeatureView:
    """Named value columns of a table, found by `keys`, valid for `ttl` after `ts`.

    `bucket` is the time slice in which as-of joins order rows of one key; None for views
    whose keys have few rows each. `strategy` is the plan of the as-of join: "interval" for views
    with few rows, "window" for ones about as large as the labels.
    """

    name: str
    keys: tuple[str, ...]
    features: tuple[str, ...]
    ttl: timedelta | None
    ts: str = "event_timestamp"
    bucket: timedelta | None = DAY
    strategy: str = "window"


@dataclass(frozen=True)
class FeatureService:
    """An ordered list of views, and columns computed from them when they are read."""

    name: str
    views: tuple[FeatureView, ...]
    on_demand: dict[str, Callable[[], Column]] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return [f for v in self.views for f in v.features] + list(self.on_demand)


# Names, keys and lifetimes of the views and services.
RECENT_ACTIVITY_VIEW = FeatureView(
    "station_recent_activity",
    ("station_id",),
    tuple(RECENT_ACTIVITY.values),
    timedelta(minutes=30),
)
LIVE_STATUS_VIEW = FeatureView(
    "station_live_status", ("station_id",), tuple(LIVE_STATUS.values), timedelta(minutes=10)
)
WEATHER_VIEW = FeatureView(
    "weather_hourly",
    ("region_id",),
    tuple(WEATHER_HOURLY.values),
    timedelta(hours=3),
    bucket=timedelta(hours=1),
    strategy="interval",
)
PROFILE_VIEW = FeatureView(
    "station_hourly_profile",
    ("station_id", "hour_of_week"),
    tuple(HOURLY_PROFILE.values),
    timedelta(days=90),
    # One row per key and week.
    bucket=None,
    strategy="interval",
)
DEMAND_SERVICE = FeatureService(
    "demand_forecast_v1",
    (RECENT_ACTIVITY_VIEW, PROFILE_VIEW, WEATHER_VIEW),
    {
        "typical_net_flow_4w": lambda: net_flow(
            F.col("avg_arrivals_4w"), F.col("avg_departures_4w")
        )
    },
)
LIVE_SERVICE = FeatureService("station_live_v1", (LIVE_STATUS_VIEW,))
BATCH_VIEWS = (PROFILE_VIEW, WEATHER_VIEW)
