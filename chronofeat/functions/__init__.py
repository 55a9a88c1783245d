"""Column functions: expressions only, so they stay inside code generation."""

from chronofeat.functions.columns import (
    age_label,
    as_number,
    clean_numeric,
    event_id,
    net_flow,
    starts_with_any,
)
from chronofeat.functions.timekit import (
    bucket_start,
    event_time_from_millis,
    hour_of_week,
    instant,
    local_to_utc_strict,
    local_wall_time,
    micros,
    weeks_to_shift,
    window_text,
)

__all__ = [
    "age_label",
    "as_number",
    "bucket_start",
    "clean_numeric",
    "event_id",
    "event_time_from_millis",
    "hour_of_week",
    "instant",
    "local_to_utc_strict",
    "local_wall_time",
    "micros",
    "net_flow",
    "starts_with_any",
    "weeks_to_shift",
    "window_text",
]
