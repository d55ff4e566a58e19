"""What a run did."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime


@dataclass
class RunResult:
    """Counts and locations of one table run."""

    run_ts: datetime | str
    load_type: str
    generation: int | None = None
    extracted: int = 0
    inserted: int = 0
    updated: int = 0
    deleted: int = 0
    merged: int = 0
    delta_path: str | None = None
    watermark: datetime | None = None
    changed_buckets: int | None = None
    table: str | None = None
    error: str | None = None

    @property
    def written(self) -> int:
        """Rows of the delta."""
        return self.inserted + self.updated + self.deleted
