from tidewater.sinks.snapshot import (
    merge_into,
    read_snapshot,
    rebucket,
    scan_snapshot,
    snapshot_writer,
    upsert_cells,
    upsert_snapshot,
    vacuum,
)
from tidewater.sinks.writers import (
    append_partition,
    apply_dim_config,
    merge_history,
    overwrite_partition,
    route_to_topics,
    write_day_buckets,
    write_events,
    write_jdbc,
)

__all__ = [
    "append_partition", "apply_dim_config", "merge_history", "merge_into", "overwrite_partition", "read_snapshot", "rebucket",
    "route_to_topics", "scan_snapshot", "snapshot_writer", "upsert_cells", "upsert_snapshot", "vacuum", "write_day_buckets",
    "write_events", "write_jdbc",
]
