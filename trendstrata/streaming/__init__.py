"""Incremental processing of newly landed documents."""

from trendstrata.streaming.reference_stream import drain_reference, start_reference_stream

__all__ = ["drain_reference", "start_reference_stream"]
