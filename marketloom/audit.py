"""Extraction audit records and their log line."""

from __future__ import annotations

import logging
from dataclasses import dataclass, field, fields
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from marketloom import schemas
from marketloom.context import new_run_id

logger = logging.getLogger("marketloom")


def _now() -> datetime:
    return datetime.now(timezone.utc)


@dataclass
class ExtractionRecord:
    run_id: str = field(default_factory=new_run_id)
    source: str = ""
    dataset: str = ""
    start_time: datetime | None = field(default_factory=_now)
    end_time: datetime | None = None
    rows_extracted: int = 0
    watermark_before: datetime | None = None
    watermark_after: datetime | None = None
    status: str = "pending"
    duration_s: float = 0.0
    error: str | None = None

    def finish(self, status: str, rows: int = 0, watermark_after: datetime | None = None,
               error: str | None = None) -> ExtractionRecord:
        self.end_time = _now()
        if self.start_time is not None:
            self.duration_s = (self.end_time - self.start_time).total_seconds()
        self.status, self.rows_extracted, self.error = status, rows, error
        if watermark_after is not None:
            self.watermark_after = watermark_after
        return self

    def as_row(self) -> tuple:
        return tuple(getattr(self, f.name) for f in fields(self))

    def log(self) -> None:
        """One ``key=value`` line per dataset; failures at error level."""
        parts = [f"run_id={self.run_id}", f"source={self.source}", f"dataset={self.dataset}"]
        if self.status == "failed":
            parts.append(f"error={self.error}")
        else:
            parts += [f"rows={self.rows_extracted}", f"watermark_before={self.watermark_before}",
                      f"watermark_after={self.watermark_after}"]
        parts += [f"duration={self.duration_s:.2f}s", f"status={self.status}"]
        logger.log(logging.ERROR if self.status == "failed" else logging.INFO, " ".join(parts))


def append_audit(spark: SparkSession, path: str, records: list[ExtractionRecord]) -> None:
    """Append one row per extracted dataset to the audit table."""
    if records:
        rows = spark.createDataFrame([r.as_row() for r in records], schemas.struct(schemas.RUN_AUDIT))
        rows.coalesce(1).write.mode("append").parquet(path)
