"""Values shared by everything one run writes."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

STAMP_FORMAT = "%Y%m%dT%H%M%SZ"


def new_run_id() -> str:
    """Random 12-digit hexadecimal id for an extraction."""
    return uuid.uuid4().hex[:12]


@dataclass(frozen=True)
class RunContext:
    captured_at: datetime
    run_id: str

    @classmethod
    def create(cls, captured_at: datetime | None = None) -> RunContext:
        at = (captured_at or datetime.now(timezone.utc)).astimezone(timezone.utc)
        return cls(at, at.strftime(STAMP_FORMAT))

    @property
    def ingestion_date(self) -> str:
        return self.captured_at.strftime("%Y-%m-%d")

    @property
    def hour(self) -> str:
        return self.captured_at.strftime("%H")

    @property
    def captured_at_col(self) -> Column:
        return F.lit(self.captured_at).cast("timestamp")
