"""Structured Streaming entry points for metric samples and purchases."""

from clientlens.streaming.monitor import (read_metric_stream, alerts_stream, messages_stream,
                                          latest_stream, history_stream, start_query,
                                          start_monitor)
from clientlens.streaming.latest import compact_latest, latest_writer, read_latest
from clientlens.streaming.purchases import STATE_STORE, dedupe_stream, transition_counts, transitions_stream

__all__ = ["read_metric_stream", "alerts_stream", "messages_stream", "latest_stream",
           "history_stream", "start_query", "start_monitor", "read_latest", "compact_latest", "latest_writer", "STATE_STORE", "dedupe_stream", "transition_counts", "transitions_stream"]
