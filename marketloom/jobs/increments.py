"""Slices of all sources into the four marts, each mart from what changed below it."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.jobs.quotes import load_quotes
from marketloom.jobs.trading import load_trading
from marketloom.operators.partials import Mergeable, PartialStore
from marketloom.operators.upsert import upsert
from marketloom.plans import daily, marts
from marketloom.sinks.tables import mart_path
from marketloom.storage import read_partitions

ACTIVITY = Mergeable(daily.event_states, daily.merge_events, daily.finish_events)
#: What the business mart takes from marts that hold nothing for a date yet.
ABSENT = {
    "trading_daily": "date date, symbol {symbol}, trading_volume decimal(38,8), total_orders bigint",
    "user_activity_daily": "date date, active_users bigint, market_views bigint",
}


def load_activity(spark: SparkSession, root: str, events: DataFrame, batch: int, now: Column | None = None) -> list:
    """Add a slice of staged user events; returns the dates whose mart rows were rewritten.

    Kept are event counts per date and user, so users seen in several slices
    count once and no event is read again.
    """
    store = PartialStore(spark, f"{root}/state/activity", ACTIVITY)
    dates = store.add(events, batch)
    if not dates:
        return []
    return upsert(spark, mart_path(root, "user_activity_daily"), marts.user_activity_daily(store.current(dates), now),
                  marts.GRAIN["user_activity_daily"], unique=True)


def refresh_business(spark: SparkSession, root: str, dates: list, now: Column | None = None) -> list:
    """Make the business mart's rows of some dates anew from these dates of the three marts below it.

    Market rows decide which rows there are, so a date without any is left for
    the slice that brings them.
    """
    market = read_partitions(spark, mart_path(root, "market_daily"), None, "date", dates)
    if market is None:
        return []
    symbol = market.schema["symbol"].dataType.simpleString()
    below = {}
    for mart, columns in ABSENT.items():
        found = read_partitions(spark, mart_path(root, mart), None, "date", dates)
        below[mart] = spark.createDataFrame([], columns.format(symbol=symbol)) if found is None else found
    rows = marts.business_metrics(market, below["trading_daily"], below["user_activity_daily"], now)
    return upsert(spark, mart_path(root, "business_metrics"), rows, marts.GRAIN["business_metrics"], unique=True)


def load_slice(spark: SparkSession, root: str, staged: Mapping[str, DataFrame], batch: int,
               now: datetime | None = None, tie_break: Column | str | None = "run_id") -> dict[str, list]:
    """Add a slice of any of summaries, orders, trades and user events; returns the touched dates per mart.

    The three marts of facts are independent and load side by side; each hands on
    the dates that it rewrote, and the business mart is made anew for these
    alone. Slices may bring late rows for any day. Loading a slice again under its
    number changes nothing and completes what a failure has left out.
    """
    stamp = None if now is None else F.lit(now).cast("timestamp")
    loads = {}
    with ThreadPoolExecutor(max_workers=3) as pool:
        if "summaries" in staged:
            loads["market_daily"] = pool.submit(load_quotes, spark, root, staged["summaries"], batch, tie_break, stamp)
        if "orders" in staged or "trades" in staged:
            loads["trading_daily"] = pool.submit(
                load_trading, spark, root, batch, staged.get("orders"), staged.get("trades"), stamp)
        if "user_events" in staged:
            loads["user_activity_daily"] = pool.submit(load_activity, spark, root, staged["user_events"], batch, stamp)
    touched = {mart: load.result() for mart, load in loads.items()}
    changed = list({d for dates in touched.values() for d in dates})
    touched["business_metrics"] = refresh_business(spark, root, changed, stamp) if changed else []
    return touched
