"""Structured Streaming variant of the incremental staging load."""

from commitlake.streaming.ingest import stream_upsert  # noqa: F401
