"""Relational sources: full and incremental scans, and the table registry."""

from __future__ import annotations

from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom import schemas

# Table and the column that marks a row as new. Fixed values.
RELATIONAL_MARKS = {
    "users": "updated_at",
    "accounts": "updated_at",
    "assets": "created_at",
    "orders": "updated_at",
    "trades": "executed_at",
    "transactions": "created_at",
}
RELATIONAL_SOURCE = "postgres"
RELATIONAL_NAMESPACE = "postgresql"


def namespace(table: str) -> str:
    return f"{RELATIONAL_NAMESPACE}.{table}"


def jdbc_options(url: str, table: str, partition_column: str | None = None, lower: Any = None,
                 upper: Any = None, partitions: int = 0, **extra: str) -> dict[str, str]:
    """Reader options; with bounds given the table is read by parallel range scans."""
    options = {"url": url, "dbtable": table, "fetchsize": "10000", **extra}
    if partition_column and partitions > 1:
        options.update(partitionColumn=partition_column, lowerBound=str(lower),
                       upperBound=str(upper), numPartitions=str(partitions))
    return options


def read_table(spark: SparkSession, name: str, root: str | None = None, fmt: str = "parquet",
               jdbc: dict[str, str] | None = None) -> DataFrame:
    """One relational table in its declared schema, from JDBC or an extract folder."""
    ddl = schemas.RELATIONAL[name]
    if jdbc is not None:
        df = spark.read.format("jdbc").options(**jdbc).load()
        return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.struct(ddl)])
    reader = spark.read.schema(ddl).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.load(f"{root.rstrip('/')}/{name}")


def read_all(spark: SparkSession, root: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    return {name: read_table(spark, name, root, fmt) for name in schemas.RELATIONAL}


def newer_than(df: DataFrame, column: str, mark: datetime | str | None, strict: bool = True) -> DataFrame:
    """Rows past the mark; everything when there is no mark.

    The comparison is on the bare column so it is pushed into the source.
    ``strict=False`` includes the mark itself: rows that arrived later with
    the very same time are not lost, and the caller removes the rows it has.
    """
    if mark is None:
        return df
    mark = F.lit(mark)
    return df.where(F.col(column) > mark if strict else F.col(column) >= mark)


def max_mark(df: DataFrame, column: str) -> datetime | None:
    """Highest mark of a batch; None for an empty one."""
    return df.agg(F.max(column)).first()[0]
