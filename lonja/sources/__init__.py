"""Where data comes from and where it is kept: databases, raw files, event feeds and the lake itself."""

from .database import Database, Split
from .feeds import (
    kafka_events,
    read_catalog,
    read_event_files,
    read_returns_history,
    read_sales_history,
    read_suppliers,
    text_events,
)
from .lake import Lake, MissingTable
from .landing import file_manifest, land_csv, land_json_array, land_lines, stamped, write_snapshot
from .manifest import Family, Manifest

__all__ = [
    "Database",
    "Family",
    "Lake",
    "Manifest",
    "MissingTable",
    "Split",
    "file_manifest",
    "kafka_events",
    "land_csv",
    "land_json_array",
    "land_lines",
    "read_catalog",
    "read_event_files",
    "read_returns_history",
    "read_sales_history",
    "read_suppliers",
    "stamped",
    "text_events",
    "write_snapshot",
]
