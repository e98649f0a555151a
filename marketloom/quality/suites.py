"""The checks of each layer, as rule lists and as fail-fast validators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.functions import is_close, nan_to_null
from marketloom.operators.dedup import orphans
from marketloom.quality.rules import (
    DataQualityError, RowRule, Rule, UniqueRule, accepted_values, expression_is_true,
    missing_columns, not_null, summary, unique,
)


class SilverQualityError(DataQualityError):
    pass


class GoldQualityError(DataQualityError):
    pass


# --- snapshot path ----------------------------------------------------------
# The columns each layer requires and the texts of the checks.
SILVER_REQUIRED = ("pair_id", "ticker_id", "last_price", "captured_at", "run_id")
SILVER_NOT_NULL = ("pair_id", "ticker_id", "last_price", "captured_at")
GOLD_REQUIRED = (
    "pair_id", "captured_at", "last_price", "price_change_24h", "price_change_24h_pct",
    "price_change_7d", "price_change_7d_pct", "spread", "spread_pct", "volume_rank", "run_id",
)
GOLD_NOT_NULL = ("pair_id", "captured_at", "last_price")
SNAPSHOT_KEY = ("pair_id", "captured_at")
TEXTS = {
    "duplicates": "Found {n} duplicate pair_id + captured_at records",
    "last_price": "Found {n} records with last_price <= 0",
    "high_low": "Found {n} records where high_price < low_price",
    "volume": "Found {n} records with negative volume_idr",
    "rank": "Found {n} records with volume_rank < 1",
    "spread": "Found {n} records with inconsistent spread calculation",
    "change_24h": "Found {n} records with inconsistent 24h price change",
    "change_7d": "Found {n} records with inconsistent 7d price change",
}


def _text(rule: Rule, n: int) -> str:
    if rule.name in TEXTS:
        return TEXTS[rule.name].format(n=n)
    return f"{rule.name.removeprefix('not_null_')} contains {n} null values"


def silver_rules() -> list[Rule]:
    return [
        *[not_null(c) for c in SILVER_NOT_NULL],
        UniqueRule("duplicates", SNAPSHOT_KEY),
        RowRule("last_price", lambda: F.col("last_price") <= 0),
        RowRule("high_low", lambda: F.col("high_price") < F.col("low_price")),
        RowRule("volume", lambda: F.col("volume_idr") < 0),
    ]


def gold_rules() -> list[Rule]:
    def off(column: str, minuend: str, subtrahend: str) -> Column:
        return ~is_close(column, F.col(minuend) - F.col(subtrahend))

    return [
        *[not_null(c) for c in GOLD_NOT_NULL],
        UniqueRule("duplicates", SNAPSHOT_KEY),
        RowRule("last_price", lambda: F.col("last_price") <= 0),
        RowRule("rank", lambda: F.col("volume_rank") < 1),
        RowRule("spread", lambda: off("spread", "sell_price", "buy_price")),
        RowRule("change_24h", lambda: off("price_change_24h", "last_price", "price_24h_ago")),
        RowRule("change_7d", lambda: off("price_change_7d", "last_price", "price_7d_ago")),
    ]


def nan_free(df: DataFrame) -> DataFrame:
    return df.withColumns({c: nan_to_null(c) for c, t in df.dtypes if t in ("double", "float")})


def _validate(df: DataFrame, required: Sequence[str], rules: Sequence[Rule], title: str, error: type) -> None:
    missing = missing_columns(required, df)
    if missing:
        raise error(f"Missing required columns: {missing}")
    counts = summary(nan_free(df), rules).first()
    failed = [_text(r, counts[r.name]) for r in rules if counts[r.name] > 0]
    if failed:
        raise error(f"{title} data quality validation failed:\n" + "\n".join(f"- {f}" for f in failed))


def validate_market_snapshot(df: DataFrame) -> None:
    """Check a Silver snapshot in one job; raise one error with all failures."""
    _validate(df, SILVER_REQUIRED, silver_rules(), "Silver", SilverQualityError)


def validate_market_metrics(df: DataFrame) -> None:
    """Check Gold metrics in one job; raise one error with all failures."""
    _validate(df, GOLD_REQUIRED, gold_rules(), "Gold", GoldQualityError)


# --- daily path -------------------------------------------------------------
EVENT_TYPES = ("market_view", "order_created", "order_updated", "login", "logout", "page_view")


def model_rules() -> dict[str, list[Rule]]:
    """Column checks of the staging and intermediate models."""
    return {
        "pairs": [not_null("pair_id"), unique("pair_id")],
        "summaries": [
            not_null("pair_id"), not_null("last_price"), not_null("buy_price"), not_null("sell_price"),
            expression_is_true("last_price_positive", "last_price > 0"),
            expression_is_true("volume_idr_not_negative", "volume_idr >= 0"),
        ],
        "user_events": [
            not_null("event_id"), unique("event_id"), not_null("event_type"),
            accepted_values("event_type", EVENT_TYPES),
        ],
        "users": [
            not_null("user_id"), unique("user_id"), not_null("email"),
            expression_is_true("email_has_at", "email LIKE '%@%'"),
        ],
        "accounts": [not_null("account_id"), unique("account_id"), not_null("user_id"), not_null("currency")],
        "assets": [not_null("asset_id"), unique("asset_id"), not_null("symbol"), unique("symbol")],
        "orders": [
            not_null("order_id"), unique("order_id"), not_null("user_id"), not_null("pair"),
            expression_is_true("price_positive", "price > 0"),
            expression_is_true("quantity_positive", "quantity > 0"),
        ],
        "trades": [
            not_null("trade_id"), unique("trade_id"), not_null("order_id"),
            expression_is_true("price_positive", "price > 0"),
            expression_is_true("quantity_positive", "quantity > 0"),
        ],
        "daily_market": [not_null("date"), not_null("symbol")],
        "orders_trades": [not_null("order_id"), not_null("user_id")],
        "daily_trading": [not_null("date"), not_null("symbol")],
        "user_events_daily": [not_null("date")],
        "user_trading_activity": [not_null("date"), not_null("user_id")],
    }


def mart_rules() -> dict[str, list[Rule]]:
    """Checks the Gold contract sets for the marts."""
    return {
        "market_daily": [
            not_null("date"), not_null("symbol"), not_null("close_price"), unique("date", "symbol"),
            expression_is_true("high_not_below_low", "high_price >= low_price"),
            expression_is_true("change_floor", "price_change_pct >= -100 OR price_change_pct IS NULL"),
        ],
        "trading_daily": [
            not_null("date"), not_null("symbol"), unique("date", "symbol"),
            expression_is_true("some_volume", "buy_volume + sell_volume > 0"),
            expression_is_true("completed_within_total", "completed_orders <= total_orders"),
        ],
        "user_activity_daily": [
            not_null("date"), unique("date"),
            expression_is_true("users_not_negative", "active_users >= 0"),
            expression_is_true("events_cover_users", "market_views + order_events + login_events >= active_users"),
        ],
    }


# --- singular checks: each returns the rows that break it --------------------
def filled_above_quantity(orders: DataFrame) -> DataFrame:
    return orders.where("filled_quantity > quantity").select("order_id", "quantity", "filled_quantity")


def orphan_trades(trades: DataFrame, orders: DataFrame) -> DataFrame:
    return orphans(trades.select("trade_id", "order_id"), orders, "order_id", "order_id")


def negative_balances(accounts: DataFrame) -> DataFrame:
    return accounts.where("balance < 0 OR locked_balance < 0").select(
        "account_id", "user_id", "balance", "locked_balance")


def non_positive_prices(orders: DataFrame, summaries: DataFrame) -> DataFrame:
    low_orders = orders.where("price <= 0").select(F.col("order_id").cast("string").alias("order_id"), "price")
    low_quotes = summaries.where("last_price <= 0").select(
        F.col("pair_id").cast("string").alias("order_id"), F.col("last_price").alias("price"))
    return low_orders.unionByName(low_quotes)


def negative_volumes(daily_market: DataFrame, daily_trading: DataFrame) -> DataFrame:
    market = daily_market.where("volume_idr < 0 OR volume_asset < 0").select(
        "date", "symbol", "volume_idr", "volume_asset")
    trading = daily_trading.where("trading_volume < 0 OR buy_volume < 0 OR sell_volume < 0").select(
        "date", "symbol", F.col("trading_volume").alias("volume_idr"),
        F.lit(0).cast("decimal(38,8)").alias("volume_asset"))
    return market.unionByName(trading)


def inconsistent_business(business: DataFrame) -> DataFrame:
    measures = ("active_users", "total_orders", "trading_volume", "market_views")
    broken = F.lit(False)
    for m in measures:
        broken = broken | (F.col(m).isNotNull() & (F.col(m) < 0))
    return business.where(broken).select("date", "symbol", *measures)
