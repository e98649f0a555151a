"""The engine's entities expressed over the TPC-H-style test tables.

Ids stay integers and timestamps stay as stored, so filters on them reach the
parquet scan. Money is cast to decimal before any arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.functions import json_string
from marketloom.session import configure


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def money(c: str, precision: int = 18) -> Column:
    return F.col(c).cast(f"decimal({precision},8)")


# event_type of the test data -> event type of the engine. Fixed values.
EVENT_TYPES = {
    "view": "market_view",
    "purchase": "order_created",
    "signup": "order_updated",
    "click": "login",
    "error": "page_view",
}
ORDER_STATUS = {"F": "filled", "P": "partially_filled", "O": "open"}


def _mapped(c: str, mapping: dict[str, str]) -> Column:
    out = F.col(c)
    for source, target in mapping.items():
        out = F.when(F.col(c) == source, F.lit(target)).otherwise(out)
    return out


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ticks_from(table(spark, sf_dir, "events"))


def ticks_from(events: DataFrame) -> DataFrame:
    """Staged summaries: one quote per event, the event type is the pair."""
    last = money("value", 28)
    return events.select(
        F.col("event_type").alias("pair_id"),
        last.alias("last_price"),
        (last * F.lit("0.9992").cast("decimal(5,4)")).cast("decimal(28,8)").alias("buy_price"),
        (last * F.lit("1.0008").cast("decimal(5,4)")).cast("decimal(28,8)").alias("sell_price"),
        (last * F.lit("1.015").cast("decimal(5,4)")).cast("decimal(28,8)").alias("high_price"),
        (last * F.lit("0.985").cast("decimal(5,4)")).cast("decimal(28,8)").alias("low_price"),
        F.col("user_id").cast("decimal(28,8)").alias("volume_asset"),
        last.alias("volume_idr"),
        F.col("ts").alias("captured_at"),
        F.col("event_id"),
    )


def user_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_events_from(table(spark, sf_dir, "events"))


def user_events_from(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id",
        _mapped("event_type", EVENT_TYPES).alias("event_type"),
        "user_id",
        json_string("props", "k").alias("session_id"),
        F.col("ts").alias("event_timestamp"),
        F.col("ts").alias("ingested_at"),
    )


def event_orders(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Orders and their fills on the events' dates and symbols: each event is an order and its fill."""
    quantity = F.get_json_object("props", "$.k").cast("decimal(18,8)")
    placed = events.select(
        F.col("event_id").alias("order_id"), "user_id", F.col("event_type").alias("pair"),
        F.lit("buy").alias("order_type"), quantity.alias("quantity"), F.lit("filled").alias("status"),
        F.col("ts").alias("updated_at"))
    fills = events.select(F.col("event_id").alias("trade_id"), F.col("event_id").alias("order_id"), quantity.alias("quantity"))
    return placed, fills


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    quantity = money("o_totalprice")
    half = (quantity * F.lit("0.5").cast("decimal(2,1)")).cast("decimal(18,8)")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderpriority").alias("pair"),
        F.when(F.col("o_orderkey") % 2 == 0, F.lit("buy")).otherwise(F.lit("sell")).alias("order_type"),
        quantity.alias("price"),
        quantity.alias("quantity"),
        F.when(F.col("o_orderstatus") == "F", quantity)
        .when(F.col("o_orderstatus") == "P", half)
        .otherwise(F.lit(0).cast("decimal(18,8)")).alias("filled_quantity"),
        _mapped("o_orderstatus", ORDER_STATUS).alias("status"),
        F.col("o_orderdate").alias("created_at"),
        F.col("o_orderdate").alias("updated_at"),
    )


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("trade_id"),
        F.col("l_orderkey").alias("order_id"),
        money("l_extendedprice").alias("price"),
        money("l_quantity").alias("quantity"),
        F.col("l_returnflag").alias("taker_side"),
        F.col("l_shipdate").alias("executed_at"),
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("account_id"),
        F.col("c_custkey").alias("user_id"),
        F.col("c_mktsegment").alias("currency"),
        money("c_acctbal").alias("balance"),
        F.col("c_nationkey").cast("decimal(18,8)").alias("locked_balance"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("transaction_id"),
        F.col("o_custkey").alias("account_id"),
        money("o_totalprice").alias("amount"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").alias("created_at"),
    )
