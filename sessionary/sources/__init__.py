"""Sources and sinks: table loading, event adapters, artifact and run tables."""

from sessionary.sources.tables import (
    EVENT_TYPE_MAP,
    RAW_EVENTS_SCHEMA,
    canonical_events,
    load_tables,
    read_raw_events_csv,
    read_table,
    raw_events,
)

__all__ = [
    "EVENT_TYPE_MAP", "RAW_EVENTS_SCHEMA", "canonical_events", "load_tables",
    "read_raw_events_csv", "read_table", "raw_events",
]
