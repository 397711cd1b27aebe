"""Streaming ingestion of quote documents."""

from quoteflow.streaming.ingest import append_raw, append_rejected, run_loads

__all__ = ["append_raw", "append_rejected", "run_loads"]
