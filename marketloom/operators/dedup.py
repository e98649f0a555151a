"""Keep-first de-duplication and anti joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key, the first in ``order``.

    ``row_number() = 1`` is planned with a group limit below the exchange, so
    each map task ships at most one row per key and a hot key stays small.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def absent_from(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key does not occur in ``right`` (nulls count as equal).

    The right side is reduced to distinct keys before it is shuffled, so a key
    repeated there costs nothing.
    """
    present = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys]).distinct()
    condition = None
    for k in keys:
        same = F.col(k).eqNullSafe(F.col(f"_r_{k}"))
        condition = same if condition is None else condition & same
    return left.join(present, condition, "left_anti")


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows without a parent; a null reference is an orphan too.

    Both sides are reduced to distinct keys before they meet, so a parent with
    very many children, or a key repeated among the parents, ships one row per
    map task. Child rows are then looked up by the keys found missing, usually
    none at all.
    """
    known = parent.select(F.col(parent_key).alias("_key")).where("_key is not null").distinct()
    keys = child.select(F.col(child_key).alias("_key")).where("_key is not null").distinct()
    missing = keys.join(known, "_key", "left_anti")
    lost = child.join(missing, F.col(child_key) == F.col("_key"), "left_semi")
    return lost.unionByName(child.where(F.col(child_key).isNull()))


def latest_only(df: DataFrame, run: str) -> DataFrame:
    """Rows of the newest run (the highest value of ``run``).

    The maximum is looked up first and used as a literal, so on a table
    partitioned by ``run`` only that partition is read.
    """
    newest = df.agg(F.max(run)).first()[0]
    return df.where(F.col(run) == F.lit(newest)) if newest is not None else df.where(F.lit(False))
