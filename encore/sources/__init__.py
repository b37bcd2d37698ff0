"""Scans, sinks and the stand-in source tables."""

from encore.sources.scans import scan_day, scan_day_range, scan_table, scan_text_log
from encore.sources.sinks import export_jdbc, fanout_by_key, stamp_date, write_day, write_snapshot

__all__ = ["export_jdbc", "fanout_by_key", "scan_day", "scan_day_range", "scan_table", "scan_text_log",
           "stamp_date", "write_day", "write_snapshot"]
