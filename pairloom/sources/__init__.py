"""Scans, newest-partition lookups, and sinks."""

from .latest import latest_partition, latest_values, next_run_number, table_partitions
from .publish import (
    Limit,
    LimitBreached,
    check_limits,
    count_metrics,
    drop_old_versions,
    observed_metrics,
    pair_metrics,
    publish_day,
)
from .scans import (
    count_rows,
    observed_rows,
    pack_small_files,
    scan_domains,
    scan_json_dir,
    scan_partitioned,
    scan_table,
    stage_json,
)
from .sinks import (
    COLUMNAR,
    PACKED,
    few_partitions,
    order_for_lookup,
    read_warehouse,
    rebalance,
    replace_day,
    write_split,
    write_warehouse,
)

__all__ = [
    "COLUMNAR", "Limit", "LimitBreached", "PACKED", "check_limits", "count_metrics", "count_rows",
    "drop_old_versions", "few_partitions", "latest_partition", "latest_values", "next_run_number", "observed_metrics", "observed_rows",
    "order_for_lookup", "pack_small_files", "pair_metrics", "publish_day", "read_warehouse",
    "rebalance", "replace_day", "scan_domains", "scan_json_dir", "scan_partitioned", "scan_table",
    "stage_json", "table_partitions", "write_split", "write_warehouse",
]
