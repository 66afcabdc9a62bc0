from .readers import (
    parse_json_lines,
    read_consolidated,
    read_event_csv,
    read_json,
    read_parquet,
    scan_report,
    with_arrival,
)
from .sinks import (
    create_tables,
    current_version,
    delete_folder,
    drop_tables,
    expire_versions,
    folder_bytes,
    insert_into,
    list_folders,
    read_version,
    reset_tables,
    write_bucketed,
    write_consolidated,
    write_keyed,
    write_parquet,
    write_version,
)
from .staging import (
    FAULTY,
    checked_events,
    checked_songs,
    log_faults,
    read_mapped_json,
    refuse_faults,
    stage_events,
    stage_songs,
    typed_events,
    typed_songs,
    with_fault,
)

__all__ = [
    "FAULTY", "folder_bytes", "list_folders", "log_faults", "parse_json_lines", "write_bucketed", "checked_events", "checked_songs", "refuse_faults", "with_fault",
    "create_tables", "current_version", "delete_folder", "drop_tables", "expire_versions", "insert_into",
    "read_consolidated", "read_event_csv", "read_json", "read_mapped_json", "read_parquet",
    "read_version", "reset_tables", "scan_report", "stage_events", "stage_songs", "typed_events",
    "typed_songs", "with_arrival", "write_consolidated", "write_keyed", "write_parquet",
    "write_version",
]
