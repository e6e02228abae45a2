"""Incremental ingestion of the landing zone with Structured Streaming."""

from larder.streaming.landing_stream import ingest_new_files, stream_bronze

__all__ = ["ingest_new_files", "stream_bronze"]
