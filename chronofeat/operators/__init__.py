"""Relational and time-series operators over event tables."""

from chronofeat.operators.activity import activity_with_zeros, trailing_activity
from chronofeat.operators.asof import asof_join
from chronofeat.operators.changes import only_changed
from chronofeat.operators.grid import bucket_counts, dense_grid, heartbeats, status_heartbeats
from chronofeat.operators.latest import dedupe_events, latest_per_key, merge_prefer_first
from chronofeat.operators.ranks import exact_quantile, seeded_cap
from chronofeat.operators.seasonal import forward_label, seasonal_profile
from chronofeat.operators.trips import (
    normalize_trips,
    observed_only,
    scope_filter,
    trip_events,
)

__all__ = [
    "activity_with_zeros",
    "asof_join",
    "bucket_counts",
    "dedupe_events",
    "dense_grid",
    "exact_quantile",
    "forward_label",
    "heartbeats",
    "latest_per_key",
    "merge_prefer_first",
    "normalize_trips",
    "observed_only",
    "only_changed",
    "scope_filter",
    "seasonal_profile",
    "seeded_cap",
    "status_heartbeats",
    "trailing_activity",
    "trip_events",
]
