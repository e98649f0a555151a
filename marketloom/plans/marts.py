"""Marts: the daily market, trading, activity and business tables.

Everything here runs on daily aggregates: one row per date and symbol, so a
window over one symbol holds at most one row per calendar day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from marketloom.functions import pct_change
from marketloom.operators.ranking import dense_rank_desc, dense_rank_in_run

GRAIN = {
    "market_daily": ["date", "symbol"],
    "trading_daily": ["date", "symbol"],
    "user_activity_daily": ["date"],
    "business_metrics": ["date", "symbol"],
}


def _by_date() -> WindowSpec:
    return Window.partitionBy("symbol").orderBy("date")


def _created(df: DataFrame, now: Column | None) -> DataFrame:
    return df if now is None else df.withColumn("created_at", now)


def market_daily(daily: DataFrame, now: Column | None = None) -> DataFrame:
    """Price performance; the change is against the previous available day."""
    previous = F.lag("close_price").over(_by_date())
    return market_daily_against(daily.withColumn("_previous", previous), now)


def market_daily_against(daily: DataFrame, now: Column | None = None) -> DataFrame:
    """The mart's rows of daily rows that carry the close before them as ``_previous``."""
    return _created(
        daily.select(
            "date", "symbol", "open_price", "high_price", "low_price", "close_price",
            pct_change("close_price", "_previous").alias("price_change_pct"),
            "volume_idr", "volume_asset",
        ),
        now,
    )


def trading_daily(daily: DataFrame, now: Column | None = None) -> DataFrame:
    return _created(
        daily.select("date", "symbol", "total_orders", "completed_orders", "buy_volume",
                     "sell_volume", "trading_volume", "avg_trade_size"),
        now,
    )


def user_activity_daily(daily: DataFrame, now: Column | None = None) -> DataFrame:
    return _created(
        daily.select("date", "active_users", "market_views", "order_events", "login_events"), now
    )


_BUSINESS = ("date", "symbol", "close_price", "market_volume", "price_change_pct",
             "trading_volume", "total_orders", "active_users", "market_views")


def business_metrics(market: DataFrame, trading: DataFrame, activity: DataFrame,
                     now: Column | None = None, full: bool = False) -> DataFrame:
    """Market, trading and activity side by side.

    By default market rows decide which rows exist; ``full=True`` keeps rows
    found in any of the three. Activity has no symbol and repeats per symbol.
    No broadcast hint: the sides are turned into broadcasts at run time where
    their measured size allows.
    """
    how = "full" if full else "left"
    m = market.select("date", "symbol", "close_price",
                      F.col("volume_idr").alias("market_volume"), "price_change_pct")
    t = trading.select("date", "symbol", "trading_volume", "total_orders")
    u = activity.select("date", "active_users", "market_views")
    joined = m.join(t, ["date", "symbol"], how).join(u, "date", how)
    return _created(joined.select(*_BUSINESS), now)


# --- further measures named by the Gold contract ----------------------------
def change_7d(market: DataFrame) -> DataFrame:
    """Percentage change against the close exactly seven days earlier."""
    week = (
        Window.partitionBy("symbol").orderBy(F.unix_date("date")).rangeBetween(-7, -7)
    )
    return market.withColumn("_week", F.first("close_price").over(week)).select(
        "date", "symbol", "close_price",
        pct_change("close_price", "_week").alias("price_change_7d_pct"),
    )


def volatility(market: DataFrame, days: int = 7) -> DataFrame:
    """Sample standard deviation of the last ``days`` daily changes.

    The contract names the measure without defining it; this is our definition.
    """
    frame = _by_date().rowsBetween(-(days - 1), 0)
    return market.select(
        "date", "symbol", "price_change_pct",
        F.stddev_samp("price_change_pct").over(frame).alias("volatility"),
    )


def volume_rank_daily(market: DataFrame, listed_symbols: bool = True) -> DataFrame:
    """Dense rank of the symbols by volume within each date, highest first.

    A date's group holds one row per symbol, never raw ticks: a few thousand
    rows for an exchange's listing. With ``listed_symbols=False`` there may be
    any number of symbols and the rank is taken over a distributed sort.
    """
    totals = market.select(
        "date", "symbol",
        F.col("volume_asset").alias("total_volume_asset"),
        F.col("volume_idr").alias("total_volume_idr"),
    )
    if not listed_symbols:
        return dense_rank_desc(totals, ["date"], "total_volume_idr", "volume_rank")
    return totals.withColumn("volume_rank", dense_rank_in_run("total_volume_idr", "date"))


def volume_change(market: DataFrame) -> DataFrame:
    """Day-over-day change of price and of volume."""
    return market.withColumn("_previous", F.lag("volume_idr").over(_by_date())).select(
        "date", "symbol", "price_change_pct",
        pct_change("volume_idr", "_previous").alias("volume_change_pct"),
    )


def price_volume_corr(market: DataFrame) -> DataFrame:
    """Correlation of price change and volume change per symbol."""
    both = F.col("price_change_pct").isNotNull() & F.col("volume_change_pct").isNotNull()
    return volume_change(market).groupBy("symbol").agg(
        F.count_if(both).alias("days"),
        F.corr("price_change_pct", "volume_change_pct").alias("correlation_score"),
    )
