"""Parquet writers for Silver and Gold snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from marketloom.functions import ingestion_hour

SILVER, GOLD = "market_snapshot", "market_metrics"


def write_snapshot(df: DataFrame, root: str, dataset: str) -> str:
    """Write snapshot rows by ingestion date, hour and run.

    Only the runs present in ``df`` are replaced, so writing a run again leaves
    one copy of it, and other runs of the same hour stay.
    """
    path = f"{root.rstrip('/')}/dataset={dataset}"
    (
        df.withColumn("hour", ingestion_hour("captured_at"))
        .hint("rebalance", "ingestion_date", "hour", "run_id").write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("ingestion_date", "hour", "run_id").parquet(path)
    )
    return path


def write_silver(df: DataFrame, root: str) -> str:
    return write_snapshot(df, root, SILVER)


def write_gold(df: DataFrame, root: str) -> str:
    return write_snapshot(df, root, GOLD)


def write_by_date(df: DataFrame, path: str, column: str = "date", order: Sequence[str] = ()) -> None:
    """Date-partitioned table; a date too big for one task is split by the rebalance.

    Rows are sorted inside files by ``order`` so its min/max statistics prune.
    """
    out = df.hint("rebalance", column)
    if order:
        out = out.sortWithinPartitions(column, *order)
    (
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(column).parquet(path)
    )


def head(df: DataFrame, n: int = 5) -> DataFrame:
    """First rows of a dataset, for a look at it."""
    return df.limit(n)


def describe_columns(df: DataFrame) -> dict[str, str]:
    return dict(df.dtypes)


