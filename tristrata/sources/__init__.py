"""Reading raw and stored tables, and writing them."""

from tristrata.sources.bronze import read_bronze, read_dated_files
from tristrata.sources.builds import Builds
from tristrata.sources.history_store import expire_runs, latest_run, read_history, record_snapshot
from tristrata.sources.landing import discover, land, land_all, read_raw, read_raw_csv, stringify
from tristrata.sources.sinks import (
    WriteLayout,
    append_silver,
    coalesce_files,
    ensure_db,
    ensure_table,
    publish,
    reload_silver,
)
from tristrata.sources.tables import Tables
from tristrata.sources.workspace import cut_lineage, fresh_folder

__all__ = [
    "Builds",
    "Tables",
    "WriteLayout",
    "append_silver",
    "coalesce_files",
    "cut_lineage",
    "discover",
    "ensure_db",
    "ensure_table",
    "expire_runs",
    "fresh_folder",
    "land",
    "land_all",
    "latest_run",
    "publish",
    "read_bronze",
    "read_dated_files",
    "read_history",
    "read_raw",
    "read_raw_csv",
    "record_snapshot",
    "reload_silver",
    "stringify",
]
