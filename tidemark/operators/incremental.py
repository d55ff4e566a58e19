"""Changes by high-watermark on timestamp columns."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import SOFT_DELETE, join_on_keys, live, project, quoted
from tidemark.functions.scalars import timestamp_literal
from tidemark.operators.audit import flag, stamp_audit
from tidemark.operators.diff import deleted_keys
from tidemark.operators.drift import append_like, union_drift


def changed_since(
    df: DataFrame, ts_cols: Sequence[str], watermark: datetime | str | Column, nulls: str = "exclude"
) -> DataFrame:
    """Rows with any of ``ts_cols`` strictly over the watermark.

    Rows whose timestamps are all NULL never qualify unless ``nulls="include"``.
    The predicate is plain, so Parquet and JDBC scans evaluate it themselves.
    """
    over = reduce(or_, [quoted(c) > timestamp_literal(watermark) for c in ts_cols])
    if nulls == "include":
        over = over | reduce(and_, [quoted(c).isNull() for c in ts_cols])
    elif nulls != "exclude":
        raise ValueError(f"nulls must be 'exclude' or 'include', not {nulls!r}")
    return df.where(over)


def _greatest(columns: Sequence[Column]) -> Column:
    return columns[0] if len(columns) == 1 else F.greatest(*columns)


def max_timestamp(
    df: DataFrame, ts_cols: Sequence[str], default: datetime | str | None = None
) -> DataFrame:
    """One row ``max_ts``: the latest value in any of ``ts_cols``, ignoring NULLs."""
    latest = _greatest([F.max(quoted(c)) for c in ts_cols])
    if default is not None:
        latest = F.coalesce(latest, timestamp_literal(default))
    return df.agg(latest.alias("max_ts"))


def next_watermark(df: DataFrame, ts_cols: Sequence[str]) -> datetime | None:
    """The watermark after delivering ``df``; None if it holds no timestamp."""
    return max_timestamp(df, ts_cols).first()["max_ts"]


def full_extract(df: DataFrame, columns: str | Sequence[str] = "*", ts_cols: Sequence[str] = ()) -> DataFrame:
    """All rows of the chosen columns, and of ``ts_cols``, which the next watermark needs."""
    names = project(df, columns).columns
    have = {c.lower() for c in names}
    return project(df, [*names, *[c for c in ts_cols if c.lower() not in have]])


def incremental_extract(
    df: DataFrame,
    ts_cols: Sequence[str],
    watermark: datetime | str | Column,
    columns: str | Sequence[str] = "*",
) -> DataFrame:
    """The chosen columns of the rows over the watermark."""
    return project(changed_since(df, ts_cols, watermark), columns)


def extract_summary(
    df: DataFrame, ts_cols: Sequence[str], default: datetime | str | None = None
) -> DataFrame:
    """Row count and latest timestamp of an extract in one pass."""
    latest = _greatest([F.max(quoted(c)) for c in ts_cols])
    if default is not None:
        latest = F.coalesce(latest, timestamp_literal(default))
    return df.agg(F.count(F.lit(1)).alias("rows"), latest.alias("max_ts"))


def timestamp_delta(
    prev_snapshot: DataFrame | None,
    curr: DataFrame,
    keys: Sequence[str],
    ts_cols: Sequence[str],
    watermark: datetime | str | Column,
    run_ts: datetime | str,
    nulls: str = "exclude",
    gone: DataFrame | None = None,
) -> DataFrame:
    """Rows over the watermark (0) and rows whose key is gone (1), audit stamped.

    ``gone`` may be the written output of ``deleted_keys``.
    """
    new = flag(changed_since(curr, ts_cols, watermark, nulls), deleted=False)
    if prev_snapshot is not None:
        prev = live(prev_snapshot).drop(SOFT_DELETE)
        new = append_like(new, flag(_rows_gone(prev, curr, keys, gone), deleted=True))
    return stamp_audit(new, run_ts)


def timestamp_snapshot(
    prev_snapshot: DataFrame | None,
    curr: DataFrame,
    keys: Sequence[str],
    gone: DataFrame | None = None,
) -> DataFrame:
    """Current rows (0) and rows deleted since the last snapshot (1); older tombstones drop out."""
    now = flag(curr, deleted=False)
    if prev_snapshot is None:
        return now
    prev = live(prev_snapshot).drop(SOFT_DELETE)
    return union_drift(now, flag(_rows_gone(prev, curr, keys, gone), deleted=True))


def _rows_gone(prev: DataFrame, curr: DataFrame, keys: Sequence[str], gone: DataFrame | None) -> DataFrame:
    if gone is None:
        gone = deleted_keys(prev, curr, keys)
    return join_on_keys(prev, gone, keys, "left_semi")
