"""Which dates each key has rows on, to find the date before and the date after."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.session import materialize
from marketloom.storage import children, read_partitions

SCHEMA = "symbol {0}, dates array<date>, year int"


class DateIndex:
    """A symbol's dates, one row per year with an array of at most 366 of them.

    A look-up reads these rows instead of the table's history, and an update
    rewrites only the years that gain a date.
    """

    def __init__(self, spark: SparkSession, path: str, symbol_type: str = "string") -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.schema = SCHEMA.format(symbol_type)

    def read(self) -> DataFrame:
        if not children(self.spark, self.path):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self.path)

    def add(self, keys: DataFrame) -> None:
        """Enter (date, symbol) rows; known ones leave the index as it is."""
        new = keys.where("date IS NOT NULL").select("symbol", "date").distinct()
        known = self.read().select(F.col("symbol").alias("_s"), F.explode("dates").alias("_d"))
        fresh = materialize(
            new.join(known, F.col("symbol").eqNullSafe(F.col("_s")) & (F.col("date") == F.col("_d")), "left_anti")
            .groupBy("symbol", F.year("date").alias("year")).agg(F.collect_set("date").alias("dates")), "new-dates")
        years = [r[0] for r in fresh.select("year").distinct().collect()]
        if not years:
            return
        rows = fresh.select("symbol", "dates", "year")
        stored = read_partitions(self.spark, self.path, self.read().schema, "year", years)
        if stored is not None:
            rows = rows.unionByName(stored).groupBy("symbol", "year").agg(
                F.array_sort(F.array_distinct(F.flatten(F.collect_list("dates")))).alias("dates"))
        # Written back where it was read from, so it is stored in between.
        (
            materialize(rows, "date-index").hint("rebalance", "year").write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy("year").parquet(self.path)
        )

    def neighbours(self, keys: DataFrame) -> DataFrame:
        """(date, symbol, previous, next): each key's nearest dates before and after, null at the ends."""
        index = self.read().select(F.col("symbol").alias("_s"), "dates")
        nearest: tuple[Column, Column] = (
            F.array_max(F.filter("dates", lambda d: d < F.col("date"))),
            F.array_min(F.filter("dates", lambda d: d > F.col("date"))),
        )
        return (
            keys.select("date", "symbol").distinct().join(index, F.col("symbol").eqNullSafe(F.col("_s")), "left")
            .groupBy("date", "symbol").agg(F.max(nearest[0]).alias("previous"), F.min(nearest[1]).alias("next"))
        )
