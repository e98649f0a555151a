"""Keep the trading mart current from slices of orders and trades."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.functions import as_date
from marketloom.operators.upsert import upsert
from marketloom.plans import daily, marts
from marketloom.session import materialize
from marketloom.sinks.tables import mart_path
from marketloom.storage import children, read_partitions

ORDER_COLUMNS = ("order_id", "pair", "order_type", "quantity", "status", "updated_at")


class TradingState:
    """What slices leave behind, each under its own batch so that a repeated one replaces itself.

    ``orders``: orders by the date of their update. ``places``: the dates of each
    order id, the way back from a trade to the days it counts on. ``sums``: trades
    summed per order; sums wait there for orders that arrive later. ``places`` and
    ``sums`` are sorted by order id, and look-ups are limited to the range of ids
    at hand, so files of other ids are not read where ids follow time.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, f"{root.rstrip('/')}/state/trading"

    def add_orders(self, orders: DataFrame, batch: int) -> list:
        """Store orders and their places; returns their dates."""
        dated = orders.select(*ORDER_COLUMNS, as_date("updated_at").alias("date")).where("date IS NOT NULL")
        self._write(dated.hint("rebalance", "date"), "orders", ["date", "batch"], batch)
        self._write(dated.select("order_id", "date").distinct().orderBy("order_id"), "places", ["batch"], batch)
        places = self._of_batch("places", batch)
        return [] if places is None else [r[0] for r in places.select("date").distinct().collect()]

    def add_trades(self, trades: DataFrame, batch: int) -> list:
        """Store trades as sums per order; returns the dates of the orders known so far."""
        sums = daily.trade_sums(trades.where("order_id IS NOT NULL")).withColumnRenamed("_order_id", "order_id")
        self._write(sums.orderBy("order_id"), "sums", ["batch"], batch)
        new = self._of_batch("sums", batch)
        places = None if new is None else self._near("places", new)
        if places is None:
            return []
        traded = new.select("order_id")
        return [r[0] for r in places.join(traded, "order_id", "left_semi").select("date").distinct().collect()]

    def rows(self, dates: list) -> DataFrame | None:
        """The trading model's rows of some dates, from their orders and these orders' sums."""
        orders = read_partitions(self.spark, f"{self.root}/orders", None, "date", dates)
        if orders is None:
            return None
        wanted = orders.select("order_id").distinct()
        sums = self._near("sums", wanted)
        if sums is None:  # no trade at all so far
            sums = wanted.limit(0).select("order_id", *[F.lit(0).cast(t).alias(c) for c, t in (
                ("_trades", "bigint"), ("_sized", "bigint"), ("_traded", "decimal(28,8)"))])
        own = sums.join(wanted, "order_id", "left_semi").withColumnRenamed("order_id", "_order_id")
        return daily.daily_trading_of(orders, daily.merge_trade_sums(own))

    def _write(self, df: DataFrame, table: str, partitions: list[str], batch: int) -> None:
        (
            df.withColumn("batch", F.lit(batch).cast("bigint")).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(f"{self.root}/{table}")
        )

    def _of_batch(self, table: str, batch: int) -> DataFrame | None:
        return read_partitions(self.spark, f"{self.root}/{table}", None, "batch", [batch])

    def _near(self, table: str, ids: DataFrame) -> DataFrame | None:
        """Rows of a table within the range of the given order ids, None where there is no table."""
        if not children(self.spark, f"{self.root}/{table}"):
            return None
        low, high = ids.agg(F.min("order_id"), F.max("order_id")).first()
        rows = self.spark.read.parquet(f"{self.root}/{table}")
        return rows.where(F.lit(False) if low is None else F.col("order_id").between(low, high))


def load_trading(spark: SparkSession, root: str, batch: int, orders: DataFrame | None = None,
                 trades: DataFrame | None = None, now: Column | None = None) -> list:
    """Add a slice of staged orders and trades; returns the dates whose mart rows were rewritten.

    A trade counts on its order's day, not on its own. So the days to make anew
    are those of the slice's orders and those of the orders that its trades
    belong to, whenever these came; no other day is read. Orders and trades are
    added, never replaced: an order id that comes again is one more order row.
    A slice loaded again under its number replaces itself.
    """
    state, dates = TradingState(spark, root), set()
    if orders is not None:
        dates.update(state.add_orders(orders, batch))
    if trades is not None:
        dates.update(state.add_trades(trades, batch))
    if not dates:
        return []
    rows = state.rows(sorted(dates))
    if rows is None:
        return []
    return upsert(spark, mart_path(root, "trading_daily"), marts.trading_daily(materialize(rows, "daily-trading"), now),
                  marts.GRAIN["trading_daily"], unique=True)
