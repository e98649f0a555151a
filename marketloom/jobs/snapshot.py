"""Snapshot run: payloads to Silver, Gold and the star schema."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from marketloom.audit import ExtractionRecord, append_audit
from marketloom.plans.snapshot import build_market_metrics, build_market_snapshot
from marketloom.plans.star import StarLoad, load_market_snapshot
from marketloom.quality.suites import validate_market_metrics, validate_market_snapshot
from marketloom.session import fit_shuffle, materialize
from marketloom.sinks.lake import write_gold, write_silver
from marketloom.sinks.tables import TableStore
from marketloom.sources.landing import API_SOURCE, check_payload, count_records


@dataclass
class SnapshotRun:
    silver_path: str
    gold_path: str
    star: StarLoad


def run_snapshot(spark: SparkSession, pairs: DataFrame, summaries: DataFrame, lake_root: str,
                 store: TableStore, on_missing: str = "raise", audit_path: str | None = None) -> SnapshotRun:
    """Build, check and publish the snapshots of the given payloads.

    A layer is published only after its checks pass. The frame is used by two
    checks, two writes and the star load, so it is computed once into the shared
    folder; the later steps read just the columns they need from there.
    """
    record = ExtractionRecord(source=API_SOURCE, dataset="market_data")
    try:
        check_payload("pairs", pairs)
        check_payload("summaries", summaries)
        record.finish("success", count_records(pairs, summaries))
    except Exception as exc:
        record.finish("failed", error=str(exc))
        raise
    finally:
        record.log()
        if audit_path:
            append_audit(spark, audit_path, [record])
    fit_shuffle(spark, summaries)
    gold = materialize(build_market_metrics(build_market_snapshot(pairs, summaries)), "gold")
    silver = gold.drop("price_change_24h", "price_change_24h_pct", "price_change_7d",
                       "price_change_7d_pct", "spread", "spread_pct", "volume_rank")
    validate_market_snapshot(silver)
    silver_path = write_silver(silver, f"{lake_root}/silver")
    validate_market_metrics(gold)
    gold_path = write_gold(gold, f"{lake_root}/gold")
    star = load_market_snapshot(spark, gold, store, on_missing)
    return SnapshotRun(silver_path, gold_path, star)
