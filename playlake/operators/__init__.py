from .asof import asof_join
from .changes import table_changes
from .clean import (
    enforce_required,
    known_users,
    plays,
    split_corrupt,
    split_valid,
    with_artist,
)
from .dedupe import distinct_rows, first_per_key, last_per_key, latest_per_key
from .keys import dense_key, hash_key, read_numbered, sparse_key, surrogate_key, write_numbered
from .merge import append_unique, assert_unique, duplicate_keys, insert_absent, merge_fields
from .resolve import first_matches, resolve_all, resolve_first
from .top import top_k, top_k_per_group

__all__ = [
    "append_unique", "asof_join", "read_numbered", "write_numbered", "table_changes", "assert_unique", "dense_key", "distinct_rows", "duplicate_keys",
    "enforce_required", "first_matches", "first_per_key", "hash_key", "insert_absent", "known_users",
    "last_per_key", "latest_per_key", "merge_fields", "plays", "resolve_all", "resolve_first",
    "sparse_key", "split_corrupt", "split_valid", "surrogate_key", "top_k", "top_k_per_group",
    "with_artist",
]
