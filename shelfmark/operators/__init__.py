"""Dataset operators: derive, conform, partition plan, delivery."""

from .conform import Profile, checks, conform, kept_columns, profile, profile_frame
from .derive import cluster_by_month, normalize, with_audit, with_partition_keys
from .partitions import (
    partition_inventory,
    partition_path,
    partition_plan,
    partitions_of,
    plan_levels,
    plan_summary,
    reloaded_partitions,
    retain_reloaded,
)
from .sink import LayoutChange, cluster_for_write, overwrite_partitions, partition_cols, write_partitioned

__all__ = [
    "LayoutChange", "Profile", "checks", "cluster_by_month", "cluster_for_write", "conform",
    "kept_columns", "normalize",
    "overwrite_partitions", "partition_cols", "partition_inventory", "partition_path",
    "partition_plan", "partitions_of", "plan_levels", "plan_summary", "profile", "profile_frame",
    "reloaded_partitions", "retain_reloaded", "with_audit", "with_partition_keys", "write_partitioned",
]
