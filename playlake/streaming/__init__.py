from .buckets import BUCKETS, expire_buckets, merge_into_buckets, read_buckets
from .compaction import append_batch, compact, read_batches
from .incremental import (
    activity_tables,
    claim,
    compact_activity,
    each_new_file,
    load_activity_files,
    merge_users_batch,
    quarantined,
    users_now,
)
from .windows import load_windowed_counts, windowed_counts

__all__ = [
    "BUCKETS", "activity_tables", "append_batch", "claim", "compact", "compact_activity", "each_new_file",
    "expire_buckets", "load_activity_files", "load_windowed_counts", "merge_into_buckets", "merge_users_batch",
    "quarantined", "read_batches", "read_buckets", "users_now", "windowed_counts",
]
