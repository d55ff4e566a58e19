"""Comparison of two states of a table.

The comparison never joins the two states. Both are reduced to
``(keys, hash)``, appended to each other and aggregated by key: the shuffle
carries narrow rows, partial aggregation collapses repeated keys before it
(so a hot or NULL key cannot load one task), NULL keys compare equal, and
duplicate keys cannot multiply. Full rows are fetched afterwards by joining
the - normally small - set of changed keys back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import CHANGE_KIND, HASH, content_columns, join_on_keys, key_columns
from tidemark.functions.hashing import row_hash

INSERTED, UPDATED, DELETED, SAME = "I", "U", "D", "S"


class DuplicateKeyError(ValueError):
    """Rows share a key that should be unique."""


def _tagged(prev: DataFrame, curr: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per distinct ``columns`` of either state: ``in_prev`` 0 or 1, ``in_curr`` its number of rows."""
    before = prev.select(*key_columns(columns), F.lit(1).alias("in_prev"), F.lit(0).alias("in_curr"))
    after = curr.select(*key_columns(columns), F.lit(0).alias("in_prev"), F.lit(1).alias("in_curr"))
    return before.unionByName(after).groupBy(*key_columns(columns)).agg(
        F.max("in_prev").alias("in_prev"), F.sum("in_curr").alias("in_curr")
    )


def with_row_hash(prev: DataFrame, curr: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Make sure both states carry ``hash_val``; a stored hash is not recomputed.

    If either has to be hashed, it is hashed over the columns of both, so a
    column present on one side only counts as NULL on the other.
    """
    if HASH in prev.columns and HASH in curr.columns:
        return prev, curr
    names = {c.lower(): c for c in [*content_columns(prev, keys), *content_columns(curr, keys)]}
    columns = list(names.values())
    return (
        prev if HASH in prev.columns else row_hash(prev, keys, columns=columns),
        curr if HASH in curr.columns else row_hash(curr, keys, columns=columns),
    )


def classified_keys(
    prev: DataFrame, curr: DataFrame, keys: Sequence[str], unique_keys: bool = False
) -> DataFrame:
    """Every key with its ``change_kind`` and its number of current rows, ``curr_rows``.

    In general a state may hold several versions of a key, which takes two
    aggregations: by key and hash, then by key. ``unique_keys`` says that the
    previous state holds every key once and that current duplicates need only
    be counted; then one aggregation does, with one shuffle, comparing least
    and greatest hash of a key.
    """
    prev, curr = with_row_hash(prev, curr, keys)
    if unique_keys:
        return _classified_unique(prev, curr, keys)
    versions = _tagged(prev, curr, [*keys, HASH])
    by_key = versions.groupBy(*key_columns(keys)).agg(
        F.max("in_prev").alias("in_prev"),
        F.sum("in_curr").alias("curr_rows"),
        F.max(F.when((F.col("in_curr") > 0) & (F.col("in_prev") == 0), 1).otherwise(0)).alias("is_new"),
    )
    kind = (
        F.when(F.col("in_prev") == 0, INSERTED)
        .when(F.col("curr_rows") == 0, DELETED)
        .when(F.col("is_new") == 1, UPDATED)
        .otherwise(SAME)
    )
    return by_key.select(*key_columns(keys), kind.alias(CHANGE_KIND), "curr_rows")


def _classified_unique(prev: DataFrame, curr: DataFrame, keys: Sequence[str]) -> DataFrame:
    # Two 64-bit numbers stand for the hash text, because fixed-width values
    # are what hash aggregation can keep in place.
    numbers = [F.xxhash64(HASH).alias("h1"), F.xxhash64(F.lit(1), F.col(HASH)).alias("h2")]
    before = prev.select(*key_columns(keys), *numbers, F.lit(1).alias("in_prev"), F.lit(0).alias("in_curr"))
    after = curr.select(*key_columns(keys), *numbers, F.lit(0).alias("in_prev"), F.lit(1).alias("in_curr"))
    by_key = before.unionByName(after).groupBy(*key_columns(keys)).agg(
        F.max("in_prev").alias("in_prev"),
        F.sum("in_curr").alias("curr_rows"),
        ((F.min("h1") != F.max("h1")) | (F.min("h2") != F.max("h2"))).alias("differs"),
    )
    kind = (
        F.when(F.col("in_prev") == 0, INSERTED)
        .when(F.col("curr_rows") == 0, DELETED)
        .when(F.col("differs"), UPDATED)
        .otherwise(SAME)
    )
    return by_key.select(*key_columns(keys), kind.alias(CHANGE_KIND), "curr_rows")


def snapshot_diff(
    prev: DataFrame, curr: DataFrame, keys: Sequence[str], unique_keys: bool = False
) -> DataFrame:
    """Classify every key of either state: ``change_kind`` is I, U, D or S (same).

    A key is updated if the current state holds a version of it that the
    previous one did not. See ``classified_keys`` for ``unique_keys``.
    """
    return classified_keys(prev, curr, keys, unique_keys).drop("curr_rows")


def inserted_keys(prev: DataFrame, curr: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys of ``curr`` that ``prev`` lacks."""
    return _tagged(prev, curr, keys).where("in_prev = 0").select(*key_columns(keys))


def deleted_keys(prev: DataFrame, curr: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys of ``prev`` that ``curr`` lacks."""
    return _tagged(prev, curr, keys).where("in_curr = 0").select(*key_columns(keys))


def updated_keys(prev: DataFrame, curr: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys of both states whose content is new in ``curr``."""
    return _of_kind(snapshot_diff(prev, curr, keys), UPDATED).select(*key_columns(keys))


def changed_keys(
    prev: DataFrame, curr: DataFrame, keys: Sequence[str], unique_keys: bool = False
) -> DataFrame:
    """Inserted, updated and deleted keys with their ``change_kind``.

    Jobs that go on to fetch full rows should write this small table and
    read it back: its file size then tells the planner whether the following
    joins can broadcast it, sparing the shuffle of the full rows.
    """
    return _of_kind(snapshot_diff(prev, curr, keys, unique_keys), INSERTED, UPDATED, DELETED)


def upsert_keys(prev: DataFrame, curr: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inserted plus updated keys."""
    return _of_kind(snapshot_diff(prev, curr, keys), INSERTED, UPDATED).select(*key_columns(keys))


def change_counts(diff: DataFrame) -> DataFrame:
    """One row with the number of keys of each kind, in a single pass."""
    return diff.agg(
        *[
            F.count(F.when(F.col(CHANGE_KIND) == kind, 1)).alias(name)
            for kind, name in (
                (INSERTED, "inserted"),
                (UPDATED, "updated"),
                (DELETED, "deleted"),
                (SAME, "unchanged"),
            )
        ]
    )


def _of_kind(changes: DataFrame, *kinds: str) -> DataFrame:
    return changes.where(F.col(CHANGE_KIND).isin(*kinds))


def rows_of_kind(
    rows: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    *kinds: str,
    keep_kind: bool = False,
    small: bool = False,
) -> DataFrame:
    """Rows whose key changed in one of the given ways; ``changes`` has one row per key.

    ``small`` is for changes whose stored size has been checked.
    """
    wanted = _of_kind(changes, *kinds)
    if keep_kind:
        return join_on_keys(rows, wanted, keys, "inner", small)
    return join_on_keys(rows, wanted.select(*key_columns(keys)), keys, "left_semi", small)


def upserts(
    prev: DataFrame, curr: DataFrame, keys: Sequence[str], changes: DataFrame | None = None
) -> DataFrame:
    """Current rows that are new or changed."""
    return rows_of_kind(curr, _changes(prev, curr, keys, changes), keys, INSERTED, UPDATED)


def deletes(
    prev: DataFrame, curr: DataFrame, keys: Sequence[str], changes: DataFrame | None = None
) -> DataFrame:
    """Previous rows whose key is gone, with their last values."""
    if changes is None:
        return join_on_keys(prev, deleted_keys(prev, curr, keys), keys, "left_semi")
    return rows_of_kind(prev, changes, keys, DELETED)


def superseded(
    prev: DataFrame, curr: DataFrame, keys: Sequence[str], changes: DataFrame | None = None
) -> DataFrame:
    """Previous versions of rows that have changed."""
    return rows_of_kind(prev, _changes(prev, curr, keys, changes), keys, UPDATED)


def _changes(prev: DataFrame, curr: DataFrame, keys: Sequence[str], changes: DataFrame | None) -> DataFrame:
    return changed_keys(prev, curr, keys) if changes is None else changes


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their row counts."""
    return df.groupBy(*key_columns(keys)).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def assert_unique_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Return ``df``, or raise with an example if a key occurs twice."""
    raise_if_any(duplicate_keys(df, keys), keys)
    return df


def raise_if_any(duplicates: DataFrame, keys: Sequence[str]) -> None:
    """Raise with an example if there are any duplicate keys."""
    example = duplicates.first()
    if example is not None:
        raise DuplicateKeyError(f"key {list(keys)} is not unique, e.g. {example.asDict()}")
