"""Where rows come from and go to: CSV trips, Parquet tables, JSON documents, topics."""

from chronofeat.sources.feeds import flatten_hourly, flatten_stations, flatten_status, map_ids
from chronofeat.sources.periods import (
    backfill_range,
    load_new_periods,
    loaded_periods,
    month_folders,
    new_periods_only,
    newest_month_paths,
    newest_periods,
    with_path_month,
)
from chronofeat.sources.tables import (
    read_feature_table,
    register_table,
    write_run_record,
    write_table,
)
from chronofeat.sources.topics import (
    in_time_order,
    kafka_options,
    parse_messages,
    read_json_files_stream,
    read_json_topic,
    to_envelope,
    write_json_folder,
    write_json_topic,
)
from chronofeat.sources.trips import read_trips
from chronofeat.sources.versions import RefreshedTable, replace_table

__all__ = [
    "RefreshedTable",
    "backfill_range",
    "flatten_hourly",
    "flatten_stations",
    "flatten_status",
    "in_time_order",
    "kafka_options",
    "load_new_periods",
    "loaded_periods",
    "map_ids",
    "month_folders",
    "new_periods_only",
    "newest_month_paths",
    "newest_periods",
    "parse_messages",
    "read_feature_table",
    "read_json_files_stream",
    "read_json_topic",
    "read_trips",
    "register_table",
    "replace_table",
    "to_envelope",
    "with_path_month",
    "write_json_folder",
    "write_json_topic",
    "write_run_record",
    "write_table",
]
