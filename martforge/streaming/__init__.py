"""Structured Streaming jobs."""

from martforge.streaming.jobs import stream_event_log, stream_ids, stream_retained_log

__all__ = ["stream_event_log", "stream_ids", "stream_retained_log"]
