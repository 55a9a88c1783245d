"""Structured Streaming: sources, sinks and the application that runs them."""

from chronofeat.streaming.pipeline import (
    activity_stream,
    demand_queries,
    dropped_by_watermark,
    start_pipeline,
)
from chronofeat.streaming.polling import changes_sink, document_stream, poll_queries
from chronofeat.streaming.sinks import (
    StreamQuery,
    compact_history,
    dual_sink,
    enrich_in_batch,
    history_sink,
    read_history,
    write_history_batch,
)

__all__ = [
    "StreamQuery",
    "activity_stream",
    "changes_sink",
    "compact_history",
    "demand_queries",
    "document_stream",
    "dropped_by_watermark",
    "dual_sink",
    "enrich_in_batch",
    "history_sink",
    "poll_queries",
    "read_history",
    "start_pipeline",
    "write_history_batch",
]
