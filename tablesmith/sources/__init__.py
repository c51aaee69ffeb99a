"""Readers and writers. Every reader turns float NaN into NULL (trap T1)."""

from tablesmith.sources.files import (nan_to_null, read_csv, read_json, read_parquet,
                                      read_table, write_csv)
from tablesmith.sources.events import (EVENT_COLUMNS, CLEAN_ACTIONS, event_log_from_activity,
                                       load_event_log, normalise_events)

__all__ = ["nan_to_null", "read_csv", "read_json", "read_parquet", "read_table", "write_csv",
           "EVENT_COLUMNS", "CLEAN_ACTIONS", "event_log_from_activity", "load_event_log",
           "normalise_events"]
