"""Training sets: labels joined with every feature as it was known at the label's time."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronofeat.functions.columns import as_number
from chronofeat.functions.timekit import hour_of_week
from chronofeat.operators.asof import Lookup, asof_join, asof_together, time_span
from chronofeat.operators.ranks import exact_quantile, seeded_cap
from chronofeat.plans.views import FeatureService, FeatureView

# The label, the model's columns in order, the row cap and its seed.
TARGET = "target_departures_next_1h"
ZERO_WHEN_MISSING = (
    "departures_15m",
    "departures_1h",
    "arrivals_15m",
    "arrivals_1h",
    "avg_departures_4w",
    "avg_arrivals_4w",
)
STAYS_MISSING = ("temperature_c", "precipitation_mm", "wind_speed_kmh")
ON_DEMAND = ("typical_net_flow_4w",)
DERIVED = ("net_flow_1h", "demand_vs_profile", "hour_of_day", "day_of_week")
MODEL_FEATURES = ZERO_WHEN_MISSING + STAYS_MISSING + ON_DEMAND + DERIVED
MAX_ROWS, CAP_SEED = 400_000, 7
VALIDATION_FRACTION = 0.2


def with_entity_keys(
    df: DataFrame, tz: str, region: str, ts: str = "event_timestamp"
) -> DataFrame:
    """Adds the keys of the other views: the local hour of the week, and the region."""
    return df.withColumns(
        {"hour_of_week": hour_of_week(F.col(ts), tz), "region_id": F.lit(region)}
    )


def point_in_time(
    labels: DataFrame,
    service: FeatureService,
    tables: dict[str, DataFrame],
    ts: str = "event_timestamp",
) -> DataFrame:
    """One row per label row, with the features of every view of `service`.

    `tables` holds each view's history by view name. Views that have the key of the first large view
    are looked up together, after one shuffle by that key, unless a key is hot. Of the others a view
    of few rows joins as intervals, any other shuffles the growing rows once. The labels' span is
    measured once for all views and bounds what is read of each history; labels are also counted per
    key, so pass a written table rather than a long computation.
    """
    joined = labels
    span = time_span(labels, ts)
    single = list(service.views)
    alike, shared = _with_shared_keys(service)
    if alike:
        lookups = [
            Lookup(tables[v.name], list(v.keys), list(v.features), v.ttl, v.ts) for v in alike
        ]
        found = asof_together(labels, lookups, shared, ts, span)
        if found is not None:
            joined, single = found, [v for v in single if v not in alike]
    for view in single:
        joined = asof_join(
            joined,
            tables[view.name],
            list(view.keys),
            list(view.features),
            view.ttl,
            ts,
            view.ts,
            view.bucket,
            counted=labels,
            strategy=view.strategy,
            span=span,
        )
    joined = joined.withColumns({name: make() for name, make in service.on_demand.items()})
    return joined.select(*labels.columns, *service.columns)


def _with_shared_keys(service: FeatureService) -> tuple[list[FeatureView], list[str]]:
    """The views that have all keys of the first large one, and these keys."""
    large = next((v for v in service.views if v.strategy == "window"), None)
    if large is None:
        return [], []
    return [v for v in service.views if set(large.keys) <= set(v.keys)], list(large.keys)


def training_set(
    labels: DataFrame,
    service: FeatureService,
    tables: dict[str, DataFrame],
    tz: str,
    region: str,
    cap: int = MAX_ROWS,
    seed: int = CAP_SEED,
) -> DataFrame:
    """Capped labels, their keys, and their features."""
    return point_in_time(with_entity_keys(seeded_cap(labels, cap, seed), tz, region), service, tables)


def model_frame(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """`keep`, then the model's columns in their order, all doubles.

    A station without activity or profile counts as quiet; missing weather stays missing.
    """
    quiet = {c: F.coalesce(as_number(F.col(c)), F.lit(0.0)) for c in ZERO_WHEN_MISSING + ON_DEMAND}
    weather = {c: as_number(F.col(c)) for c in STAYS_MISSING}
    base = df.select(*keep, F.col("hour_of_week").alias("_how"), *[
        column.alias(name) for name, column in (quiet | weather).items()
    ])
    return base.withColumns(
        {
            "net_flow_1h": F.col("arrivals_1h") - F.col("departures_1h"),
            "demand_vs_profile": F.col("departures_1h") / (F.col("avg_departures_4w") + 1.0),
            "hour_of_day": (F.col("_how") % 24).cast("double"),
            "day_of_week": F.floor(F.col("_how") / 24).cast("double"),
        }
    ).select(*keep, *MODEL_FEATURES)


def time_cutoff(
    df: DataFrame, ts: str = "event_timestamp", fraction: float = VALIDATION_FRACTION
) -> float:
    """The time, in epoch microseconds, after which the newest `fraction` of rows lies; exact."""
    return exact_quantile(df, ts, 1 - fraction)


def time_split(
    df: DataFrame,
    ts: str = "event_timestamp",
    fraction: float = VALIDATION_FRACTION,
    flag: str = "is_validation",
    reference: DataFrame | None = None,
    cutoff: float | None = None,
) -> DataFrame:
    """Adds a flag to the newest `fraction` of rows: those strictly after the time quantile.

    The cutoff is exact. It may be taken from `reference`, any frame with the same times:
    the labels are far cheaper to scan than the training set joined from them. The flag
    compares the time itself, so filtering on it reaches the scan.
    """
    if cutoff is None:
        cutoff = time_cutoff(df if reference is None else reference, ts, fraction)
    # Times are whole microseconds: later than the cutoff means later than its whole part.
    whole = F.timestamp_micros(F.lit(math.floor(cutoff)))
    return df.withColumn(flag, F.col(ts) > whole)


def capped_split(
    labels: DataFrame, cap: int, seed: int = CAP_SEED, cutoff: float | None = None
) -> DataFrame:
    """`time_split` of all labels with at most `cap` rows to fit on; every held-out row stays."""
    split = time_split(labels, cutoff=cutoff)
    fitted = seeded_cap(split.where(~F.col("is_validation")), cap, seed)
    return fitted.unionByName(split.where("is_validation"))
