"""Structured Streaming: incremental ingest of newly landed documents."""

from chartlake.streaming.incremental import ingest, process_batch  # noqa: F401
