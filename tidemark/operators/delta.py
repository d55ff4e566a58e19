"""Deltas, snapshots and history built from a comparison."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import CHANGE_KIND, HASH, SOFT_DELETE, join_on_keys, key_columns, live, tombstones
from tidemark.functions.scalars import timestamp_literal
from tidemark.operators.audit import flag, stamp_audit
from tidemark.operators.diff import (
    DELETED,
    INSERTED,
    UPDATED,
    changed_keys,
    deletes,
    rows_of_kind,
    upserts,
    with_row_hash,
)
from tidemark.operators.drift import append_like, union_drift


def snapshot_delta(
    prev: DataFrame | None,
    curr: DataFrame,
    keys: Sequence[str],
    run_ts: datetime | str,
    changes: DataFrame | None = None,
) -> DataFrame:
    """Upserts (``soft_delete`` 0) and tombstones (1), audit stamped.

    Without a previous state every current row is an insert. Columns the
    source no longer has are left out. ``changes`` may be the written output
    of ``changed_keys``.
    """
    if prev is None:
        return stamp_audit(flag(curr, deleted=False), run_ts)
    if changes is None:
        prev, curr = with_row_hash(prev, curr, keys)
        changes = changed_keys(prev, curr, keys)
    new = flag(upserts(prev, curr, keys, changes), deleted=False)
    gone = flag(deletes(prev, curr, keys, changes), deleted=True)
    return stamp_audit(append_like(new, gone), run_ts)


def replaced_rows(
    prev: DataFrame, changes: DataFrame, keys: Sequence[str], small: bool = False
) -> DataFrame:
    """Superseded and deleted previous rows in one join, with ``change_kind`` U or D."""
    return rows_of_kind(prev, changes, keys, UPDATED, DELETED, keep_kind=True, small=small)


def next_snapshot(
    prev_snapshot: DataFrame | None,
    curr: DataFrame,
    keys: Sequence[str],
    changes: DataFrame | None = None,
) -> DataFrame:
    """Current rows (0) with superseded, newly deleted and all earlier tombstone rows (1)."""
    if prev_snapshot is None:
        return flag(curr, deleted=False)
    prev = live(prev_snapshot).drop(SOFT_DELETE)
    if changes is None:
        prev, curr = with_row_hash(prev, curr, keys)
        changes = changed_keys(prev, curr, keys)
    replaced = flag(replaced_rows(prev, changes, keys).drop(CHANGE_KIND), deleted=True)
    now = union_drift(flag(curr, deleted=False), replaced)
    return union_drift(now, tombstones(prev_snapshot))


def start_history(curr: DataFrame, keys: Sequence[str], run_ts: datetime | str) -> DataFrame:
    """History of a table seen for the first time: one open version per row."""
    if HASH not in curr.columns:
        _, curr = with_row_hash(curr, curr, keys)
    now = timestamp_literal(run_ts)
    return curr.withColumns(
        {
            CHANGE_KIND: F.lit(INSERTED),
            "valid_from": now,
            "valid_to": F.lit(None).cast("timestamp_ntz"),
            "closed_by": F.lit(None).cast("string"),
        }
    )


def apply_scd2(
    history: DataFrame,
    curr: DataFrame,
    keys: Sequence[str],
    run_ts: datetime | str,
    changes: DataFrame | None = None,
) -> DataFrame:
    """Slowly changing dimension, type 2: versions with ``valid_from`` and ``valid_to``.

    Open versions of updated and deleted keys are closed at ``run_ts``
    (``closed_by`` says which), inserted and updated rows open a version.
    Closed versions pass through without joining.
    """
    is_open = F.col("valid_to").isNull()
    kept, begun = _scd2_versions(history.where(is_open), curr, keys, run_ts, changes)
    return union_drift(union_drift(history.where(~is_open), kept), begun)


def scd2_step(
    opened: DataFrame,
    curr: DataFrame,
    keys: Sequence[str],
    run_ts: datetime | str,
    changes: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The same in two parts: versions closed by this run, and all versions open after it.

    For a history stored apart: the first part is appended to the closed
    versions, which are never read again, and the second replaces the open ones.
    """
    kept, begun = _scd2_versions(opened, curr, keys, run_ts, changes)
    is_open = F.col("valid_to").isNull()
    return kept.where(~is_open), union_drift(kept.where(is_open), begun)


def _scd2_versions(
    opened: DataFrame, curr: DataFrame, keys: Sequence[str], run_ts: datetime | str, changes: DataFrame | None
) -> tuple[DataFrame, DataFrame]:
    """Open versions, closed where their key changed, and newly begun ones."""
    now = timestamp_literal(run_ts)
    if HASH not in curr.columns:
        curr, _ = with_row_hash(curr, curr, keys)
    if changes is None:
        changes = changed_keys(opened, curr, keys)
    ended = changes.where(F.col(CHANGE_KIND).isin(UPDATED, DELETED)).withColumnRenamed(CHANGE_KIND, "__ended_by")
    kept = (
        join_on_keys(opened, ended, keys, "left")
        .withColumns(
            {
                "valid_to": F.when(F.col("__ended_by").isNotNull(), now),
                "closed_by": F.col("__ended_by"),
            }
        )
        .drop("__ended_by")
    )
    begun = rows_of_kind(curr, changes, keys, INSERTED, UPDATED, keep_kind=True).withColumns(
        {
            "valid_from": now,
            "valid_to": F.lit(None).cast("timestamp_ntz"),
            "closed_by": F.lit(None).cast("string"),
        }
    )
    return kept, begun


def as_of(history: DataFrame, moment: datetime | str) -> DataFrame:
    """The versions valid at ``moment``."""
    at = timestamp_literal(moment)
    return history.where(
        (F.col("valid_from") <= at) & (F.col("valid_to").isNull() | (F.col("valid_to") > at))
    )


def current_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key columns only; the scan reads nothing else."""
    return df.select(*key_columns(keys))
