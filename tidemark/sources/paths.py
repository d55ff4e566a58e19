"""Where the datasets of one table live under a base URI."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone


@dataclass(frozen=True)
class TablePaths:
    """Dataset locations of ``database.schema.table`` under any Hadoop file-system URI."""

    base: str
    database: str
    schema: str
    table: str
    target_table: str | None = None

    @property
    def root(self) -> str:
        return f"{self.base.rstrip('/')}/data/{self.database}/{self.schema}/{self.table}"

    @property
    def snapshot(self) -> str:
        return f"{self.root}/snapshot"

    @property
    def incremental(self) -> str:
        return f"{self.root}/incremental"

    @property
    def raw(self) -> str:
        return f"{self.root}/raw"

    @property
    def target(self) -> str:
        """Under the target table's own name if it has one."""
        name = self.target_table or self.table
        return f"{self.base.rstrip('/')}/data/{self.database}/{self.schema}/{name}/target"

    def run_dir(self, run_ts: datetime | str) -> str:
        """Directory of one run's delta."""
        return f"{self.incremental}/{run_name(run_ts)}"


def run_name(run_ts: datetime | str) -> str:
    """Directory name of a run: ``yyyymmdd_HHMMSS``, with microseconds where there are any.

    A time with a zone is taken in UTC, as everywhere.
    """
    if isinstance(run_ts, str):
        run_ts = datetime.fromisoformat(run_ts)
    if run_ts.tzinfo is not None:
        run_ts = run_ts.astimezone(timezone.utc)
    return run_ts.strftime("%Y%m%d_%H%M%S_%f" if run_ts.microsecond else "%Y%m%d_%H%M%S")
