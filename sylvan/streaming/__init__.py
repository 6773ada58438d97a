"""Structured Streaming entry points (incremental landing of exports)."""

from sylvan.streaming.landing import export_stream, land_exports

__all__ = ["export_stream", "land_exports"]
