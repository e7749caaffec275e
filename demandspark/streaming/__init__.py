"""Structured Streaming: the panel as an event-time windowed aggregation, and stream-static enrichment."""

from demandspark.streaming.panel_stream import enrich_stream, panel_stream, read_events_stream, run_to_table, scoring_tables

__all__ = ["enrich_stream", "panel_stream", "read_events_stream", "run_to_table", "scoring_tables"]
