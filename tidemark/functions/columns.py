"""Column lists, key handling and key joins shared by every operator."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The column names the framework itself adds to deltas,
# landing tables and targets.
SOFT_DELETE = "soft_delete"
HASH = "hash_val"
BUCKET = "bucket"
CHANGE_KIND = "change_kind"
AUDIT_COLUMNS = ("load_ts", "insert_ts", "update_ts", "delete_ts")
FRAMEWORK_COLUMNS = (
    "soft_delete",
    "hash_val",
    "load_ts",
    "insert_ts",
    "update_ts",
    "delete_ts",
    "is_deleted",
    "file_name",
    "__load_ts",
    "__file_name",
    "__soft_delete",
)
#: Names that the runs add to what they store; a source's columns of these names are renamed.
RESERVED = frozenset({*FRAMEWORK_COLUMNS, BUCKET, CHANGE_KIND, "generation", "__applied_ts", "__data_ts"})
CONTROL_COLUMNS = ("EDW_INSERTED_TIMESTAMP", "EDW_UPDATED_TIMESTAMP")


class MissingColumnsError(ValueError):
    """A table lacks columns an operator needs."""


def quoted(name: str) -> Column:
    """Column by exact name, safe for names with dots or spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def _without(columns: Iterable[str], excluded: Iterable[str]) -> list[str]:
    drop = {c.lower() for c in excluded}
    return [c for c in columns if c.lower() not in drop]


def business_columns(df: DataFrame, extra: Iterable[str] = ()) -> list[str]:
    """Columns of ``df`` in order, minus the framework's own (any case)."""
    return _without(df.columns, [*FRAMEWORK_COLUMNS, *extra])


def non_key_columns(df: DataFrame, keys: Sequence[str]) -> list[str]:
    """Business columns that are not part of the key (any case)."""
    return _without(business_columns(df), keys)


def content_columns(df: DataFrame, keys: Sequence[str]) -> list[str]:
    """What a row hash covers: all but the key and the columns a snapshot adds (any case)."""
    return _without(df.columns, [*keys, SOFT_DELETE, HASH, BUCKET])


def clear_of_framework(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with columns that are named like the framework's own renamed, and the new names by lower-case old ones.

    ``bucket`` becomes ``source_bucket``, or ``source_source_bucket`` if there is such a column already.
    """
    taken = {c.lower() for c in df.columns}
    renamed: dict[str, str] = {}
    for name in df.columns:
        if name.lower() in RESERVED:
            new = f"source_{name}"
            while new.lower() in taken:
                new = f"source_{new}"
            taken.add(new.lower())
            renamed[name.lower()] = new
    return df.withColumnsRenamed({c: renamed[c.lower()] for c in df.columns if c.lower() in renamed}), renamed


def table_columns(df: DataFrame, exclude: Iterable[str] = CONTROL_COLUMNS) -> list[str]:
    """Columns in ordinal order without the target's control columns."""
    return _without(df.columns, exclude)


def probe_columns(df: DataFrame) -> list[str]:
    """Column names of a source; reads its schema only, no rows."""
    return df.columns


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """``SELECT * EXCEPT (names)``; absent names are ignored."""
    return df.drop(*names)


def require_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """Return ``df``, or raise naming every required column it lacks."""
    have = {c.lower() for c in df.columns}
    missing = sorted(c for c in required if c.lower() not in have)
    if missing:
        raise MissingColumnsError(f"missing required columns: {missing}")
    return df


def project(df: DataFrame, columns: str | Sequence[str] = "*") -> DataFrame:
    """Projection by ``"*"``, a comma list or a sequence of names."""
    if isinstance(columns, str):
        if columns.strip() in ("", "*"):
            return df
        columns = [c.strip() for c in columns.split(",") if c.strip()]
    return df.select(*[quoted(c) for c in columns])


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` rows, for display."""
    return df.limit(n)


def row_count(df: DataFrame) -> DataFrame:
    """One-row DataFrame ``rows``; a JDBC or Parquet scan answers it by push-down."""
    return df.agg(F.count(F.lit(1)).alias("rows"))


def live(df: DataFrame) -> DataFrame:
    """Rows not flagged as deleted."""
    return df.where(F.col(SOFT_DELETE) == 0)


def tombstones(df: DataFrame) -> DataFrame:
    """Rows flagged as deleted."""
    return df.where(F.col(SOFT_DELETE) == 1)


def key_columns(keys: Sequence[str]) -> list[Column]:
    return [quoted(k) for k in keys]


def join_on_keys(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, small: bool = False
) -> DataFrame:
    """Null-safe equi-join on ``keys``; the result keeps the left key columns.

    ``small`` is for a right side whose stored size has been checked: it is
    broadcast. Otherwise Spark broadcasts it only if its statistics are under
    ``spark.sql.autoBroadcastJoinThreshold`` and else shuffles, with adaptive
    skew splitting of the left side.
    """
    if small:
        right = F.broadcast(right)
    aliases = {k: f"__right_key_{i}" for i, k in enumerate(keys)}
    right = right.withColumnsRenamed(aliases)
    condition = reduce(and_, [quoted(k).eqNullSafe(F.col(a)) for k, a in aliases.items()])
    return left.join(right, condition, how).drop(*aliases.values())
