from tidewater.sources.event_log import EventLog, append_log, read_log
from tidewater.sources.ingest import (
    SYNC_TYPES,
    create_table,
    ingest_full,
    ingest_inc,
    map_type,
    warehouse_schema,
)
from tidewater.sources.readers import (
    decode_value,
    load_device_records,
    parse_json,
    read_cdc,
    read_events,
    read_jdbc_table,
    read_json_lines,
    scan,
    snake_to_camel,
)

__all__ = [
    "SYNC_TYPES", "EventLog", "append_log", "create_table", "decode_value", "ingest_full", "ingest_inc", "load_device_records", "map_type",
    "parse_json", "read_cdc", "read_events", "read_jdbc_table", "read_json_lines", "read_log", "scan", "snake_to_camel",
    "warehouse_schema",
]
