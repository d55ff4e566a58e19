"""Change flags and audit timestamps."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import SOFT_DELETE
from tidemark.functions.scalars import timestamp_literal


def flag(df: DataFrame, deleted: bool) -> DataFrame:
    """Set ``soft_delete`` to 1 (deleted) or 0 (live) on every row."""
    return df.withColumn(SOFT_DELETE, F.lit(int(deleted)))


def stamp_audit(df: DataFrame, run_ts: datetime | str) -> DataFrame:
    """Add ``load_ts`` to all rows, insert/update times to live and delete time to deleted ones."""
    now = timestamp_literal(run_ts)
    is_live = F.col(SOFT_DELETE) == 0
    is_deleted = F.col(SOFT_DELETE) == 1
    return df.withColumns(
        {
            "load_ts": now,
            "insert_ts": F.when(is_live, now),
            "update_ts": F.when(is_live, now),
            "delete_ts": F.when(is_deleted, now),
        }
    )
