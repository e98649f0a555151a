"""Upsert by unique key into a date-partitioned parquet table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from marketloom.operators.dedup import absent_from
from marketloom.session import materialize
from marketloom.sinks.lake import write_by_date
from marketloom.storage import read_partitions


def merge_rows(existing: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Existing rows with matching keys replaced by updates, new keys added.

    Nothing is deleted. Keys compare null-safe, so repeating an upsert changes
    nothing.
    """
    kept = absent_from(existing, updates, keys)
    return updates.unionByName(kept.select(*updates.columns))


def upsert(spark: SparkSession, path: str, updates: DataFrame, keys: Sequence[str],
           date_column: str = "date", unique: bool = False) -> list[date | None]:
    """Merge ``updates`` into the table at ``path``; returns the touched dates.

    ``keys`` include the date, so only partitions of touched dates are read and
    rewritten; their list has one entry per calendar day. The updates, which
    are usually the result of a long aggregation, are computed once; a key found
    twice among them is an error, unless ``unique`` states that they come from a
    grouping by the key, which saves looking for one. All partitions are committed by one job, with rows sorted by
    the remaining keys so that file statistics prune on them.
    """
    updates = materialize(updates, "upsert")
    twice = None if unique else updates.groupBy(*keys).count().where("count > 1").head()
    if twice:
        raise ValueError(f"key occurs {twice['count']} times in the updates: {twice.asDict()}")
    touched = [r[0] for r in updates.select(date_column).distinct().collect()]
    if not touched:
        return []
    existing = read_partitions(spark, path, updates.schema, date_column, touched)
    rows = updates if existing is None else merge_rows(existing, updates, keys)
    rest = [k for k in keys if k != date_column]
    write_by_date(rows, path, date_column, order=rest)
    return touched
