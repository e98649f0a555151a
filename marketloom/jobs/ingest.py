"""Incremental extraction to Bronze with marks committed after the write."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from marketloom.audit import ExtractionRecord, append_audit
from marketloom.context import RunContext
from marketloom.operators.state import MarkStore
from marketloom.sinks.bronze import write_bronze
from marketloom.sources import documents, tables

Reader = Callable[[str], DataFrame]


@dataclass(frozen=True)
class Dataset:
    """What one incremental dataset needs: where it belongs and how it is sliced."""

    name: str
    source: str           # name kept with the mark
    bronze_source: str    # name in the Bronze layout
    namespace: str
    mark_column: str
    is_document: bool = False

    def slice(self, df: DataFrame, mark: datetime | None, strict: bool) -> DataFrame:
        if self.is_document:
            return documents.newer_documents(df, mark, strict)
        return tables.newer_than(df, self.mark_column, mark, strict)


RELATIONAL = [
    Dataset(t, tables.RELATIONAL_SOURCE, tables.RELATIONAL_NAMESPACE, tables.namespace(t), column)
    for t, column in tables.RELATIONAL_MARKS.items()
]
DOCUMENTS = [
    Dataset(c, documents.DOCUMENT_SOURCE, documents.DOCUMENT_SOURCE, documents.namespace(c),
            "ingested_at", is_document=True)
    for c in documents.COLLECTIONS
]


@dataclass
class Extracted:
    path: str | None
    mark: datetime | None
    record: ExtractionRecord


def extract_one(dataset: Dataset, read: Reader, root: str, mark: datetime | None,
                ctx: RunContext, strict: bool = True, records: list[ExtractionRecord] | None = None) -> Extracted:
    """Write one dataset's new rows to Bronze and report its new mark.

    Count and mark are observed while the rows are written, so the source is
    read once and the mark belongs to exactly the rows written. An empty batch
    leaves neither files nor a new mark.
    """
    record = ExtractionRecord(run_id=ctx.run_id, source=dataset.source, dataset=dataset.name,
                              watermark_before=mark)
    if records is not None:
        records.append(record)
    try:
        batch = dataset.slice(read(dataset.name), mark, strict)
        if batch.isEmpty():
            record.finish("success", 0, mark)
            return Extracted(None, None, record)
        seen = Observation()
        at = F.col(dataset.mark_column).cast("timestamp")
        checked = documents.enforce_envelope(batch) if dataset.is_document else batch
        counted = checked.observe(seen, F.count(F.lit(1)).alias("n"),
                                  F.max(F.unix_micros(at)).alias("mark"))
        path = write_bronze(counted, root, dataset.name, ctx, dataset.bronze_source)
        metrics = seen.get  # the batch has rows; an error in reading them must fail the run
        new_mark = _from_micros(metrics["mark"])
        record.finish("success", metrics["n"], new_mark)
        return Extracted(path, new_mark, record)
    except Exception as exc:
        record.finish("failed", error=str(exc))
        raise
    finally:
        record.log()


def _from_micros(micros: int | None) -> datetime | None:
    if micros is None:
        return None
    return datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=micros)


def run_ingestion(spark: SparkSession, sources: Mapping[str, tuple[list[Dataset], Reader]], root: str,
                  marks: MarkStore, ctx: RunContext, audit_path: str | None = None,
                  strict: bool = True, threads: int = 6) -> dict[str, str]:
    """Extract all sources concurrently, then commit their marks.

    Independent jobs share the cluster through a driver thread pool. Any failure
    fails the run before a mark moves; the next run reads the same slice again
    and, for the same run id, overwrites what was written. All marks move in one
    commit, and every dataset's record reaches the audit table, failed or not.
    """
    stored = marks.all()
    records: list[ExtractionRecord] = []
    work = [(d, read) for datasets, read in sources.values() for d in datasets]
    try:
        with ThreadPoolExecutor(max_workers=threads) as pool:
            jobs = [pool.submit(extract_one, d, read, root, stored.get(d.namespace), ctx, strict, records)
                    for d, read in work]
        results = [job.result() for job in jobs]
        done = [(d, r) for (d, _), r in zip(work, results) if r.path]
        marks.commit({d.namespace: r.mark for d, r in done if r.mark}, {d.namespace: d.source for d, _ in done})
    finally:
        if audit_path:
            append_audit(spark, audit_path, records)
    return {f"{d.bronze_source}.{d.name}": r.path for d, r in done}

