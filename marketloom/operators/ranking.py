"""Ordinals over whole tables without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.session import materialize

# monotonically_increasing_id() keeps the row's position in the low 33 bits
# and the partition number above them.
_ROW_BITS = 33


def with_row_index(df: DataFrame, order: Sequence[Column | str], name: str, start: int = 1) -> DataFrame:
    """Number all rows 1, 2, 3 ... in ``order``, ties in any order.

    A range-partitioned sort gives each row a position inside its partition;
    the sorted rows are written once so positions stay fixed, then each
    partition's start is added from a table with one row per partition.
    """
    positioned = materialize(
        df.orderBy(*order).withColumn("_pos", F.monotonically_increasing_id()), "row-index"
    ).withColumn("_part", F.shiftrightunsigned("_pos", _ROW_BITS))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        positioned.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    in_partition = F.col("_pos").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    # ``starts`` holds one row per partition of the sort: bounded by
    # spark.sql.shuffle.partitions whatever the data size.
    return (
        positioned.join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + in_partition + F.lit(start))
        .drop("_pos", "_part", "_start")
    )


def dense_rank_desc(df: DataFrame, within: Sequence[str], value: str, name: str) -> DataFrame:
    """Dense rank of ``value``, highest first; a missing value has no rank.

    The frame, often the end of a long aggregation, is computed once and stored.
    Rows without a value are set apart before anything is shuffled, however many
    they are. The others' distinct values are numbered in (group, value) order
    over the whole table and each group's first number is subtracted, so one
    huge group is spread over many tasks.
    """
    keys = [*within, value]
    stored = materialize(df, "ranked")
    valued = stored.where(F.col(value).isNotNull())
    indexed = with_row_index(valued.select(*keys).distinct(), [*within, F.col(value).desc()], "_idx")
    firsts = indexed.groupBy(*within).agg(F.min("_idx").alias("_first"))
    ranks = (
        _join(indexed, firsts, within, "inner")
        .select(*keys, (F.col("_idx") - F.col("_first") + 1).cast("bigint").alias(name))
    )
    unvalued = stored.where(F.col(value).isNull()).withColumn(name, F.lit(None).cast("bigint"))
    return _join(valued, ranks, within, "inner", value).unionByName(unvalued)


def dense_rank_in_run(value: str, run_key: str = "run_id") -> Column:
    """Dense rank inside groups of a known small size, as one window.

    Meant for the rows of one API document, which one task has read anyway, or
    the listed symbols of one date. ``dense_rank_desc`` is for all other groups.
    """
    w = Window.partitionBy(run_key).orderBy(F.col(value).desc_nulls_last())
    return F.when(F.col(value).isNotNull(), F.dense_rank().over(w)).cast("bigint")


def _join(left: DataFrame, right: DataFrame, group: Sequence[str], how: str,
          value: str | None = None) -> DataFrame:
    """Equi-join on a group, null-safe, and a value that is never null on the right."""
    keys = [*group, value] if value else list(group)
    renamed = right.select(
        *[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns]
    )
    condition = None
    for k in keys:
        same = F.col(k) == F.col(f"_r_{k}") if k == value else F.col(k).eqNullSafe(F.col(f"_r_{k}"))
        condition = same if condition is None else condition & same
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])
