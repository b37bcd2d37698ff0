"""Structured Streaming entry points."""

from encore.streaming.client_log_stream import land_client_log, land_play_table

__all__ = ["land_client_log", "land_play_table"]
