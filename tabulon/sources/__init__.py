"""Scans and sinks."""

from .tables import (load, read_raw_csv, write_table, append_partitions, write_settings,
                     read_settings, patch_settings, snapshot, reuse_or_compute,
                     extract_log_table, extract_numeric_pairs, count_tables)

__all__ = ["load", "read_raw_csv", "write_table", "append_partitions", "write_settings",
           "read_settings", "patch_settings", "snapshot", "reuse_or_compute",
           "extract_log_table", "extract_numeric_pairs", "count_tables"]
