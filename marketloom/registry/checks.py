"""Registered queries: data-quality checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.plans import daily, marts
from marketloom.plans.snapshot import build_market_metrics
from marketloom.quality import rules, suites
from marketloom.registry import inputs as src
from marketloom.registry import sqltext as q
from marketloom.registry.catalog import register
from marketloom.registry.snapshot import GOLD_BY_DAY, SILVER_BY_DAY, event_documents, silver_by_day, stg_pairs, stg_users
from marketloom.sources import documents


def _counts(df: DataFrame, rule_list: list, model: str) -> DataFrame:
    return rules.long_summary(model, df, rule_list)


def _count_sql(model: str, table: str, conditions: dict[str, str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{model}' AS model, '{name}' AS rule, count(CASE WHEN {cond} THEN 1 END) AS violations FROM {table}"
        for name, cond in conditions.items()
    )


def _duplicates_sql(model: str, name: str, table: str, keys: str, where: str = "TRUE") -> str:
    return (f"SELECT '{model}' AS model, '{name}' AS rule, "
            f"CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS violations FROM "
            f"(SELECT count(*) AS n FROM {table} WHERE {where} GROUP BY {keys})")


# --- the one-pass suites -------------------------------------------------------
@register("dq_silver_summary", q.with_ctes(SILVER_BY_DAY, _count_sql("silver", "silver", {
    "not_null_pair_id": "pair_id IS NULL", "not_null_ticker_id": "ticker_id IS NULL",
    "not_null_last_price": "last_price IS NULL", "not_null_captured_at": "captured_at IS NULL",
    "last_price": "last_price <= 0", "high_low": "high_price < low_price", "volume": "volume_idr < 0",
}) + "\nUNION ALL\n" + _duplicates_sql("silver", "duplicates", "silver", "pair_id, captured_at")))
def dq_silver_summary(spark, sf_dir):
    """All Silver rules in one pass; some quotes have a low above the high."""
    return _counts(suites.nan_free(silver_by_day(spark, sf_dir)), suites.silver_rules(), "silver")


@register("dq_gold_summary", q.with_ctes(GOLD_BY_DAY, _count_sql("gold", "gold", {
    "not_null_pair_id": "pair_id IS NULL", "not_null_captured_at": "captured_at IS NULL",
    "not_null_last_price": "last_price IS NULL", "last_price": "last_price <= 0", "rank": "volume_rank < 1",
    "spread": "abs(spread - (sell_price - buy_price)) > 1e-8",
    "change_24h": "abs(price_change_24h - (last_price - price_24h_ago)) > 1e-8",
    "change_7d": "abs(price_change_7d - (last_price - price_7d_ago)) > 1e-8",
}) + "\nUNION ALL\n" + _duplicates_sql("gold", "duplicates", "gold", "pair_id, captured_at")))
def dq_gold_summary(spark, sf_dir):
    gold = build_market_metrics(silver_by_day(spark, sf_dir), one_document_per_run=False)
    return _counts(suites.nan_free(gold), suites.gold_rules(), "gold")


@register("dq_model_rules", q.with_ctes(",\n".join([q.DAILY_MARKET, q.DAILY_TRADING, q.EVENTS_DAILY, q.ACTIVE]), "\nUNION ALL\n".join([
    _count_sql("orders", "ord", {
        "not_null_order_id": "order_id IS NULL", "not_null_user_id": "user_id IS NULL",
        "not_null_pair": "pair IS NULL", "price_positive": "NOT price > 0", "quantity_positive": "NOT quantity > 0"}),
    _duplicates_sql("orders", "unique_order_id", "ord", "order_id"),
    _count_sql("trades", "trd", {
        "not_null_trade_id": "trade_id IS NULL", "not_null_order_id": "order_id IS NULL",
        "price_positive": "NOT price > 0", "quantity_positive": "NOT quantity > 0"}),
    _duplicates_sql("trades", "unique_trade_id", "trd", "trade_id"),
    _count_sql("user_events", "user_events", {
        "not_null_event_id": "event_id IS NULL", "not_null_event_type": "event_type IS NULL",
        "accepted_values_event_type": "event_type NOT IN ('market_view','order_created','order_updated','login','logout','page_view')"}),
    _duplicates_sql("user_events", "unique_event_id", "user_events", "event_id"),
    _count_sql("summaries", "ticks", {
        "not_null_pair_id": "pair_id IS NULL", "not_null_last_price": "last_price IS NULL",
        "not_null_buy_price": "buy_price IS NULL", "not_null_sell_price": "sell_price IS NULL",
        "last_price_positive": "NOT last_price > 0", "volume_idr_not_negative": "NOT volume_idr >= 0"}),
    _count_sql("accounts", "customer", {
        "not_null_account_id": "c_custkey IS NULL", "not_null_user_id": "c_custkey IS NULL",
        "not_null_currency": "c_mktsegment IS NULL"}),
    _duplicates_sql("accounts", "unique_account_id", "customer", "c_custkey"),
    _count_sql("users", "customer", {
        "not_null_user_id": "c_custkey IS NULL", "not_null_email": "c_name IS NULL", "email_has_at": "FALSE"}),
    _duplicates_sql("users", "unique_user_id", "customer", "c_custkey", "c_custkey IS NOT NULL"),
    _count_sql("assets", "part", {"not_null_asset_id": "p_partkey IS NULL", "not_null_symbol": "p_brand IS NULL"}),
    _duplicates_sql("assets", "unique_asset_id", "part", "p_partkey", "p_partkey IS NOT NULL"),
    _duplicates_sql("assets", "unique_symbol", "part", "p_brand", "p_brand IS NOT NULL"),
    _count_sql("pairs", "part", {"not_null_pair_id": "p_partkey IS NULL"}),
    _duplicates_sql("pairs", "unique_pair_id", "part", "p_partkey", "p_partkey IS NOT NULL"),
    _count_sql("daily_market", "daily_market", {"not_null_date": "date IS NULL", "not_null_symbol": "symbol IS NULL"}),
    _count_sql("orders_trades", "orders_trades", {"not_null_order_id": "order_id IS NULL", "not_null_user_id": "user_id IS NULL"}),
    _count_sql("daily_trading", "daily_trading", {"not_null_date": "date IS NULL", "not_null_symbol": "symbol IS NULL"}),
    _count_sql("user_events_daily", "events_daily", {"not_null_date": "date IS NULL"}),
    _count_sql("user_trading_activity", "active", {"not_null_date": "date IS NULL", "not_null_user_id": "user_id IS NULL"}),
])))
def dq_model_rules(spark, sf_dir):
    """Every column rule of the 13 models; trade ids and symbols repeat in the test data."""
    orders, trades, events = src.orders(spark, sf_dir), src.trades(spark, sf_dir), src.user_events(spark, sf_dir)
    models = {
        "orders": orders, "trades": trades, "user_events": events, "summaries": src.ticks(spark, sf_dir),
        "accounts": src.accounts(spark, sf_dir), "users": stg_users(spark, sf_dir),
        "assets": src.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("asset_id"), F.col("p_brand").alias("symbol")),
        "pairs": stg_pairs(spark, sf_dir),
        "daily_market": daily.daily_market(src.ticks(spark, sf_dir), "event_id"),
        "orders_trades": daily.orders_trades(orders, trades), "daily_trading": daily.daily_trading(orders, trades),
        "user_events_daily": daily.user_events_daily(events),
        "user_trading_activity": daily.user_trading_activity(orders, trades, events),
    }
    return rules.run_rules(models, suites.model_rules())


@register("dq_mart_rules", q.with_ctes(q.MARKET_DAILY + ",\n" + q.DAILY_TRADING + ",\n" + q.EVENTS_DAILY, "\nUNION ALL\n".join([
    _count_sql("market_daily", "market_daily", {
        "not_null_date": "date IS NULL", "not_null_symbol": "symbol IS NULL",
        "not_null_close_price": "close_price IS NULL", "high_not_below_low": "high_price < low_price",
        "change_floor": "price_change_pct < -100"}),
    _duplicates_sql("market_daily", "unique_date_symbol", "market_daily", "date, symbol"),
    _count_sql("trading_daily", "daily_trading", {
        "not_null_date": "date IS NULL", "not_null_symbol": "symbol IS NULL",
        "some_volume": "NOT buy_volume + sell_volume > 0",
        "completed_within_total": "completed_orders > total_orders"}),
    _duplicates_sql("trading_daily", "unique_date_symbol", "daily_trading", "date, symbol"),
    _count_sql("user_activity_daily", "events_daily", {
        "not_null_date": "date IS NULL", "users_not_negative": "active_users < 0",
        "events_cover_users": "market_views + order_events + login_events < active_users"}),
    _duplicates_sql("user_activity_daily", "unique_date", "events_daily", "date"),
])))
def dq_mart_rules(spark, sf_dir):
    orders, trades = src.orders(spark, sf_dir), src.trades(spark, sf_dir)
    models = {
        "market_daily": marts.market_daily(daily.daily_market(src.ticks(spark, sf_dir), "event_id")),
        "trading_daily": marts.trading_daily(daily.daily_trading(orders, trades)),
        "user_activity_daily": marts.user_activity_daily(daily.user_events_daily(src.user_events(spark, sf_dir))),
    }
    return rules.run_rules(models, suites.mart_rules())


# --- single checks: violation rows ---------------------------------------------
@register("dq_not_null", q.with_ctes(SILVER_BY_DAY, "SELECT pair_id, run_id, last_price FROM silver WHERE volume_idr IS NULL"))
def dq_not_null(spark, sf_dir):
    bad = rules.violations(silver_by_day(spark, sf_dir), rules.not_null("volume_idr"))
    return bad.select("pair_id", "run_id", "last_price")


@register("dq_unique", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def dq_unique(spark, sf_dir):
    return rules.violations(src.table(spark, sf_dir, "lineitem"), rules.unique("l_orderkey", "l_linenumber"))


@register("dq_accepted_values", """
SELECT event_id, event_type, user_id FROM events WHERE event_type NOT IN ('view', 'click', 'purchase')""")
def dq_accepted_values(spark, sf_dir):
    rule = rules.accepted_values("event_type", ("view", "click", "purchase"))
    return rules.violations(src.table(spark, sf_dir, "events"), rule).select("event_id", "event_type", "user_id")


@register("dq_expression", """
SELECT c_custkey, c_name, c_acctbal FROM customer WHERE NOT c_name LIKE '%1%'""")
def dq_expression(spark, sf_dir):
    rule = rules.expression_is_true("name_has_one", "c_name LIKE '%1%'")
    return rules.violations(src.table(spark, sf_dir, "customer"), rule).select("c_custkey", "c_name", "c_acctbal")


@register("dq_relationships", """
SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events WHERE user_id IS NOT NULL)""")
def dq_relationships(spark, sf_dir):
    """Customers no event refers to."""
    return rules.relationship(
        src.table(spark, sf_dir, "customer").select("c_custkey", "c_name"), "c_custkey",
        src.table(spark, sf_dir, "events"), "user_id")


@register("dq_orphans", q.with_ctes(q.ORDERS + ",\n" + q.TRADES, """
SELECT t.trade_id, t.order_id FROM trd t LEFT JOIN ord o ON t.order_id = o.order_id WHERE o.order_id IS NULL"""))
def dq_orphans(spark, sf_dir):
    return suites.orphan_trades(src.trades(spark, sf_dir), src.orders(spark, sf_dir))


@register("orders_without_trades", q.with_ctes(q.ORDERS + ",\n" + q.TRADES, """
SELECT o.order_id, o.status FROM ord o LEFT JOIN trd t ON o.order_id = t.order_id WHERE t.order_id IS NULL"""))
def orders_without_trades(spark, sf_dir):
    return suites.orphans(src.orders(spark, sf_dir).select("order_id", "status"),
                          src.trades(spark, sf_dir), "order_id", "order_id")


@register("dq_balance", """
SELECT c_custkey AS account_id, c_custkey AS user_id, CAST(c_acctbal AS DECIMAL(18,8)) AS balance,
       CAST(c_nationkey AS DECIMAL(18,8)) AS locked_balance
FROM customer WHERE c_acctbal < 0 OR c_nationkey < 0""")
def dq_balance(spark, sf_dir):
    return suites.negative_balances(src.accounts(spark, sf_dir))


@register("dq_filled_quantity", q.with_ctes(q.ORDERS, """
SELECT order_id, quantity, filled_quantity FROM ord WHERE filled_quantity > quantity"""))
def dq_filled_quantity(spark, sf_dir):
    return suites.filled_above_quantity(src.orders(spark, sf_dir))


# Shifting all prices down by a fixed amount makes the checks below find rows.
_SHIFT = 50000
_TICK_SHIFT = 20


@register("dq_positive_prices", q.with_ctes(q.ORDERS + ",\n" + q.TICKS, f"""
SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(price - {_SHIFT} AS DECIMAL(38,8)) AS price FROM ord
WHERE price - {_SHIFT} <= 0
UNION ALL
SELECT pair_id, CAST(last_price - {_TICK_SHIFT} AS DECIMAL(38,8)) FROM ticks WHERE last_price - {_TICK_SHIFT} <= 0"""))
def dq_positive_prices(spark, sf_dir):
    orders = src.orders(spark, sf_dir).withColumn("price", F.col("price") - _SHIFT)
    ticks = src.ticks(spark, sf_dir).withColumn("last_price", F.col("last_price") - _TICK_SHIFT)
    return suites.non_positive_prices(orders, ticks).withColumn("price", F.col("price").cast("decimal(38,8)"))


@register("dq_nonneg_volumes", q.with_ctes(q.DAILY_MARKET + ",\n" + q.DAILY_TRADING, f"""
SELECT date, symbol, CAST(volume_idr - {_SHIFT} AS DECIMAL(38,8)) AS volume_idr, volume_asset FROM daily_market
WHERE volume_idr - {_SHIFT} < 0 OR volume_asset < 0
UNION ALL
SELECT date, symbol, CAST(trading_volume - {_TICK_SHIFT} AS DECIMAL(38,8)), CAST(0 AS DECIMAL(38,8)) FROM daily_trading
WHERE trading_volume - {_TICK_SHIFT} < 0 OR buy_volume < 0 OR sell_volume < 0"""))
def dq_nonneg_volumes(spark, sf_dir):
    market = daily.daily_market(src.ticks(spark, sf_dir), "event_id")
    trading = daily.daily_trading(src.orders(spark, sf_dir), src.trades(spark, sf_dir))
    bad = suites.negative_volumes(
        market.withColumn("volume_idr", F.col("volume_idr") - _SHIFT),
        trading.withColumn("trading_volume", F.col("trading_volume") - _TICK_SHIFT),
    )
    return bad.withColumns({c: F.col(c).cast("decimal(38,8)") for c in ("volume_idr", "volume_asset")})


@register("dq_consistency", q.with_ctes(q.DAILY_MARKET + ",\n" + q.EVENTS_DAILY, f"""
SELECT m.date, m.symbol, u.active_users - 200 AS active_users, CAST(NULL AS BIGINT) AS total_orders,
       CAST(m.volume_idr - {_SHIFT} AS DECIMAL(38,8)) AS trading_volume, u.market_views
FROM daily_market m LEFT JOIN events_daily u ON m.date = u.date
WHERE u.active_users - 200 < 0 OR m.volume_idr - {_SHIFT} < 0 OR u.market_views < 0"""))
def dq_consistency(spark, sf_dir):
    market = daily.daily_market(src.ticks(spark, sf_dir), "event_id")
    activity = daily.user_events_daily(src.user_events(spark, sf_dir))
    business = market.join(activity, "date", "left").select(
        "date", "symbol", (F.col("active_users") - 200).alias("active_users"),
        F.lit(None).cast("bigint").alias("total_orders"),
        (F.col("volume_idr") - _SHIFT).cast("decimal(38,8)").alias("trading_volume"), "market_views",
    )
    return suites.inconsistent_business(business)


@register("reconciliation", """
WITH booked AS (SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(18,8))) AS booked FROM orders GROUP BY 1)
SELECT c_custkey AS account_id, CAST(c_acctbal AS DECIMAL(18,8)) AS balance,
       CAST(coalesce(booked, 0) AS DECIMAL(38,8)) AS booked,
       CAST(CAST(c_acctbal AS DECIMAL(18,8)) - coalesce(booked, 0) AS DECIMAL(38,8)) AS difference
FROM customer LEFT JOIN booked ON c_custkey = o_custkey
WHERE abs(CAST(c_acctbal AS DECIMAL(18,8)) - coalesce(booked, 0)) > 0.00000001""")
def reconciliation(spark, sf_dir):
    """Accounts whose balance is not the sum of their transactions."""
    bad = rules.reconcile(src.accounts(spark, sf_dir), src.transactions(spark, sf_dir))
    return bad.withColumns({c: F.col(c).cast("decimal(38,8)") for c in ("booked", "difference")})


@register("freshness_gaps", """
WITH present AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders),
span AS (SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM present)
SELECT date FROM span WHERE date NOT IN (SELECT date FROM present)""")
def freshness_gaps(spark, sf_dir):
    """Days without any order between the first and the last."""
    return rules.freshness_gaps(src.table(spark, sf_dir, "orders"), "o_orderdate")


def _quarantine_rules() -> list[rules.RowRule]:
    return [
        rules.expression_is_true("balance_not_negative", "balance >= 0"),
        rules.accepted_values("currency", ("BUILDING", "MACHINERY", "FURNITURE")),
        rules.expression_is_true("locked_below_20", "locked_balance < 20"),
    ]


@register("quarantine_split", """
WITH tagged AS (
  SELECT c_custkey AS account_id, list_filter([
           CASE WHEN c_acctbal < 0 THEN 'balance_not_negative' END,
           CASE WHEN c_mktsegment NOT IN ('BUILDING', 'MACHINERY', 'FURNITURE') THEN 'accepted_values_currency' END,
           CASE WHEN c_nationkey >= 20 THEN 'locked_below_20' END], lambda x: x IS NOT NULL) AS broken
  FROM customer)
SELECT account_id, len(broken) = 0 AS accepted, array_to_string(broken, ',') AS broken_rules FROM tagged""")
def quarantine_split(spark, sf_dir):
    """Accounts split into accepted and rejected rows, with the rules broken."""
    valid, rejected = rules.quarantine(src.accounts(spark, sf_dir), _quarantine_rules())
    return valid.select("account_id", F.lit(True).alias("accepted"), F.lit("").alias("broken_rules")).unionByName(
        rejected.select("account_id", F.lit(False).alias("accepted"),
                        F.array_join("broken_rules", ",").alias("broken_rules")))


def _odd_documents(spark, sf_dir) -> DataFrame:
    """Documents with defects: errors lack the event, signups the context, views a full time."""
    event = F.col("event")
    return event_documents(spark, sf_dir).select(
        "_id",
        F.when(event != "error", event).alias("event"),
        F.when(event != "click", event).alias("event_type"),
        F.when(event == "purchase", F.lit("[]")).when(event != "signup", F.col("context")).alias("context"),
        F.when(event == "view", F.substring("ingested_at", 1, 10)).otherwise(F.col("ingested_at")).alias("ingested_at"),
    )


@register("dq_envelope", """
SELECT CAST(event_id AS VARCHAR) AS event_id, CASE event_type WHEN 'error' THEN 'event' ELSE 'context' END AS missing
FROM events WHERE event_type IN ('error', 'signup')""")
def dq_envelope(spark, sf_dir):
    """Documents without a required envelope field."""
    return documents.envelope_violations(_odd_documents(spark, sf_dir)).select(
        F.col("_id").alias("event_id"), F.array_join("missing", ",").alias("missing"))


@register("dq_document_warnings", """
WITH d AS (SELECT CAST(event_id AS VARCHAR) AS event_id, event_type FROM events)
SELECT 'user_events' AS collection, event_id, 'event_type is required' AS warning FROM d WHERE event_type = 'click'
UNION ALL SELECT 'user_events', event_id, 'context is required' FROM d WHERE event_type = 'signup'
UNION ALL SELECT 'user_events', event_id, 'context must be an object' FROM d WHERE event_type = 'purchase'
UNION ALL SELECT 'user_events', event_id, 'ingested_at must be ISO-8601' FROM d WHERE event_type = 'view'
UNION ALL SELECT 'tickers', event_id, 'event is required' FROM d WHERE event_type = 'error'
UNION ALL SELECT 'tickers', event_id, 'context is required' FROM d WHERE event_type = 'signup'
UNION ALL SELECT 'tickers', event_id, 'context must be an object' FROM d WHERE event_type = 'purchase'
UNION ALL SELECT 'tickers', event_id, 'ingested_at must be ISO-8601' FROM d WHERE event_type = 'view'""")
def dq_document_warnings(spark, sf_dir):
    """Warnings of the collection validators."""
    docs = _odd_documents(spark, sf_dir)
    return documents.document_warnings(docs, "user_events").unionByName(
        documents.document_warnings(docs, "tickers"))
