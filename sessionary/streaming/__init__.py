"""Structured Streaming forms of the session and per-minute counts."""

from sessionary.streaming.sessions import (
    canonical_event_stream,
    minute_views_stream,
    session_counts_stream,
)

__all__ = ["canonical_event_stream", "minute_views_stream", "session_counts_stream"]
