"""Parquet tables below one root folder, with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marketloom import schemas
from marketloom.functions import cast_to
from marketloom.session import materialize
from marketloom.storage import exists, make_dirs, read_partitions


def route_schema(custom: str | None, default: str) -> str:
    """A model's own schema name is used as it stands, else the target's."""
    return custom.strip() if custom and custom.strip() else default


def mart_path(root: str, mart: str, schema: str | None = "marts") -> str:
    return f"{root.rstrip('/')}/{route_schema(schema, 'main')}/{mart}"


def conform(df: DataFrame, ddl: str) -> DataFrame:
    """Select and cast to a declared schema."""
    return df.select(*[cast_to(f.name, f.dataType.simpleString()).alias(f.name) for f in schemas.struct(ddl)])


class TableStore:
    """Named parquet tables at ``root/schema/table``."""

    def __init__(self, spark: SparkSession, root: str, schema: str | None = None, default: str = "main"):
        self.spark = spark
        self.schema = route_schema(schema, default)
        self.root = f"{root.rstrip('/')}/{self.schema}"

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def exists(self, table: str) -> bool:
        return exists(self.spark, self.path(table))

    def read(self, table: str, ddl: str | None = None) -> DataFrame:
        reader = self.spark.read
        ddl = ddl or schemas.STAR.get(table)
        return (reader.schema(ddl) if ddl else reader).parquet(self.path(table))

    def read_partitions(self, table: str, column: str, values: list) -> DataFrame:
        """Rows of the given partitions of a table with a declared schema."""
        schema = schemas.struct(schemas.STAR[table])
        found = read_partitions(self.spark, self.path(table), schema, column, values)
        return self.spark.createDataFrame([], schema) if found is None else found

    def create(self, table: str) -> None:
        """Create an empty table unless it is there; reads declare its schema."""
        make_dirs(self.spark, self.path(table))

    def create_star(self) -> None:
        for table in schemas.STAR:
            self.create(table)

    def replace(self, df: DataFrame, table: str, ddl: str | None = None) -> None:
        """Create or replace a table with a declared schema."""
        out = conform(df, ddl) if ddl else df
        out.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(self.path(table))

    def append(self, df: DataFrame, table: str, partition_by: str | None = None) -> int:
        """Append and return the number of rows.

        The rows are computed once, into a stored step that is then counted.
        """
        ddl = schemas.STAR.get(table)
        out = materialize(conform(df, ddl) if ddl else df, "append")
        n = out.count()
        if partition_by:
            out = out.hint("rebalance", partition_by)
        writer = out.write.mode("append")
        if partition_by:
            writer = writer.partitionBy(partition_by)
        writer.parquet(self.path(table))
        return n


def save_table(df: DataFrame, name: str, ddl: str | None = None, mode: str = "overwrite") -> None:
    """Catalog variant of ``replace``/``append``."""
    (conform(df, ddl) if ddl else df).write.mode(mode).format("parquet").saveAsTable(name)
