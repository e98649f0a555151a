"""Word patterns and small column helpers shared by the corpus operators."""

from __future__ import annotations

import sys
from types import ModuleType

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketloom.session import configure, fit_shuffle

SPACES = r"\x20\x09-\x0D"
WORD = f"[^{SPACES}]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the test data, with the shuffle sized to its files."""
    df = configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")
    fit_shuffle(spark, df)
    return df


def word_count(text: str = "text") -> Column:
    """Words of a text as a long; a missing text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def prefix_sums(parts: DataFrame, keys: list[str], part: str, value: str, out: str,
                fan: int = 4096) -> DataFrame:
    """Sum of ``value`` over the smaller parts of the same keys.

    ``parts`` has one row per (keys, part), ``part`` a long from 0. Parts are
    summed in blocks of ``fan``, so no window sees more than ``fan`` rows of a
    key, or one row per block of parts.
    """
    blocked = parts.withColumn("_block", F.expr(f"{part} div {fan}"))
    inner = Window.partitionBy(*keys, "_block").orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        blocked.groupBy(*keys, "_block").agg(F.sum(value).alias("_sum"))
        .withColumn("_before", F.coalesce(F.sum("_sum").over(outer), F.lit(0)))
        .drop("_sum")
    )
    return (
        blocked.withColumn("_within", F.coalesce(F.sum(value).over(inner), F.lit(0)))
        .join(blocks, [*keys, "_block"])
        .withColumn(out, F.col("_before") + F.col("_within"))
        .drop("_block", "_before", "_within")
    )


def worker_state(name: str) -> dict:
    """A dict that a Python worker process keeps from task to task.

    Functions travel to the workers as code, so their own globals do not last;
    this one lives in a module that only the worker knows.
    """
    state = sys.modules.setdefault("_marketloom_worker", ModuleType("_marketloom_worker"))
    return state.__dict__.setdefault(name, {})
