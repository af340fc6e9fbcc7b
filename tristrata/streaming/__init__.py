"""Structured Streaming jobs."""

from tristrata.streaming.silver_stream import keep_state_on_disk, newest_stream, raw_stream, silver_stream, stream_to_silver

__all__ = ["keep_state_on_disk", "newest_stream", "raw_stream", "silver_stream", "stream_to_silver"]
