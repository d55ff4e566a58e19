"""Incremental table synchronisation on Spark: compare, capture changes, merge."""

from tidemark.functions.hashing import bucket_count, bucket_fingerprint, changed_buckets, hash_bucket, row_hash
from tidemark.operators.audit import flag, stamp_audit
from tidemark.operators.delta import apply_scd2, as_of, next_snapshot, snapshot_delta, start_history
from tidemark.operators.diff import (
    assert_unique_keys,
    change_counts,
    changed_keys,
    deleted_keys,
    deletes,
    inserted_keys,
    snapshot_diff,
    superseded,
    updated_keys,
    upserts,
)
from tidemark.operators.drift import add_columns, drop_column, map_types, schema_drift, union_drift
from tidemark.operators.incremental import (
    changed_since,
    full_extract,
    incremental_extract,
    max_timestamp,
    timestamp_delta,
    timestamp_snapshot,
)
from tidemark.operators.merge import POLICIES, MergePolicy, latest_per_key, load_to_target, merge_delta
from tidemark.plans.load import load_delta, merge_into
from tidemark.plans.snapshot_cdc import run_snapshot_cdc
from tidemark.plans.sync import sync_tables
from tidemark.plans.timestamp_cdc import run_timestamp_cdc
from tidemark.sinks.generations import GenerationStore
from tidemark.sources.paths import TablePaths
from tidemark.specs import TableSpec, read_specs

__all__ = [n for n in dir() if not n.startswith("_")]
