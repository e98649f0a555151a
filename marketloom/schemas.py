"""Declared schemas. Nothing in this package infers a schema."""

from __future__ import annotations

from pyspark.sql.types import StructType

# --- relational tables ------------------------------------------------------
RELATIONAL = {
    "users": "user_id string, email string, full_name string, is_active boolean, "
             "created_at timestamp, updated_at timestamp",
    "accounts": "account_id string, user_id string, currency string, "
                "balance decimal(18,8), locked_balance decimal(18,8), "
                "created_at timestamp, updated_at timestamp",
    "assets": "asset_id string, symbol string, name string, precision int, created_at timestamp",
    "orders": "order_id string, user_id string, pair string, order_type string, "
              "price decimal(18,8), quantity decimal(18,8), filled_quantity decimal(18,8), "
              "status string, created_at timestamp, updated_at timestamp",
    "trades": "trade_id string, order_id string, price decimal(18,8), "
              "quantity decimal(18,8), taker_side string, executed_at timestamp",
    "transactions": "transaction_id string, account_id string, amount decimal(18,8), "
                    "type string, status string, created_at timestamp",
}

# --- document collections ---------------------------------------------------
# The JSON reader keeps an object met by a string field as its JSON text.
DOCUMENT = "_id string, event string, event_type string, context string, ingested_at string"
USER_EVENTS = "_id string, event string, context string, ingested_at string"
TICKER_CONTEXT = (
    "pair string, ticker_id string, last_price double, buy_price double, sell_price double, "
    "high_24h double, low_24h double, volume_idr double, timestamp string"
)
ORDERBOOK_CONTEXT = (
    "pair string, bids array<array<double>>, asks array<array<double>>, timestamp string"
)

# --- exchange API payloads --------------------------------------------------
PAIRS_PAYLOAD = (
    "id string, ticker_id string, traded_currency_unit string, base_currency string, "
    "traded_currency string, description string"
)
SUMMARIES_PAYLOAD = (
    "tickers map<string, map<string, string>>, "
    "prices_24h map<string, string>, prices_7d map<string, string>"
)

# --- tabular forms of the payloads ------------------------------------------
PAIRS = (
    "pair string, ticker_id string, name string, base_currency string, quote_currency string, "
    "price_decimal_places int, min_price decimal(18,8), max_price decimal(18,8), "
    "min_volume decimal(18,8), created_at timestamp, run_id string"
)
SUMMARIES = (
    "pair string, last string, buy string, sell string, high string, low string, "
    "vol_coin string, vol_idr string, created_at timestamp, run_id string"
)

# --- snapshot frames --------------------------------------------------------
MARKET_SNAPSHOT = (
    "pair_id string, ticker_id string, asset_name string, buy_price double, sell_price double, "
    "high_price double, low_price double, last_price double, price_24h_ago double, "
    "price_7d_ago double, volume_asset double, volume_idr double, source_timestamp timestamp, "
    "captured_at timestamp, ingestion_date string, source_file string, run_id string"
)
MARKET_METRICS = MARKET_SNAPSHOT + (
    ", price_change_24h double, price_change_24h_pct double, price_change_7d double, "
    "price_change_7d_pct double, spread double, spread_pct double, volume_rank bigint"
)

# --- star schema ------------------------------------------------------------
DIM_MARKET = "market_key bigint, pair_id string, ticker_id string, asset_name string"
DIM_DATE = "date_key int, full_date date, year int, month int, day int"
FACT_SNAPSHOT = (
    "market_key bigint, date_key int, captured_at timestamp, run_id string, buy_price double, "
    "sell_price double, high_price double, low_price double, last_price double, "
    "price_change_24h_pct double, price_change_7d_pct double, spread_pct double, "
    "volume_asset double, volume_idr double, volume_rank bigint"
)
STAR = {"dim_market": DIM_MARKET, "dim_date": DIM_DATE, "fact_market_snapshot": FACT_SNAPSHOT}

# --- state and audit --------------------------------------------------------
WATERMARK = "namespace string, source string, last_watermark timestamp, updated_at timestamp"
RUN_AUDIT = (
    "run_id string, source string, dataset string, start_time timestamp, end_time timestamp, "
    "rows_extracted bigint, watermark_before timestamp, watermark_after timestamp, "
    "status string, duration_s double, error string"
)


def struct(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


def columns(ddl: str) -> list[str]:
    return struct(ddl).fieldNames()
