"""Registered queries: payload parsing, staging, snapshots and the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom import functions as fx
from marketloom.operators.dedup import keep_first, latest_only
from marketloom.plans import models, snapshot, staging, star
from marketloom.registry import inputs as src
from marketloom.registry import sqltext as q
from marketloom.registry.catalog import register
from marketloom.sources import tables
from marketloom.sources.catalog import register_models
from marketloom.sources.landing import dataset_root


def naive(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names})


# --- payloads: every event is one API document with one ticker ---------------
def _payloads(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """(pairs, summaries) in the raw payload shape, numbers as text."""
    events = src.table(spark, sf_dir, "events")
    pairs = events.select(F.col("event_type").alias("id")).distinct().select(
        "id", F.concat("id", F.lit("_idr")).alias("ticker_id"),
        F.upper("id").alias("traded_currency_unit"),
        F.lit("idr").alias("base_currency"), F.col("id").alias("traded_currency"),
    )
    value = F.col("value").cast("string")
    ticker = F.create_map(
        F.lit("name"), F.initcap("event_type"),
        F.lit("buy"), value, F.lit("sell"), value, F.lit("high"), value, F.lit("low"), value,
        F.lit("last"), value,
        F.lit("server_time"), F.unix_seconds(F.col("ts").cast("timestamp")).cast("string"),
        F.lit("vol_idr"), value,
        F.concat(F.lit("vol_"), "event_type"), F.col("user_id").cast("string"),
    )
    k = F.get_json_object("props", "$.k")
    stamp = fx.run_stamp(F.col("ts").cast("timestamp"))
    summaries = events.select(
        F.create_map(F.concat("event_type", F.lit("_idr")), ticker).alias("tickers"),
        F.create_map("event_type", k).alias("prices_24h"),
        # No 7-day price for one of the types: the lookup misses.
        F.create_map(F.when(F.col("event_type") == "error", F.lit("other")).otherwise(F.col("event_type")), k)
        .alias("prices_7d"),
        F.col("event_id").cast("string").alias("run_id"),
        F.col("ts").cast("timestamp").alias("captured_at"),
        F.concat(F.lit("landing/summaries_"), stamp, F.lit(".json")).alias("source_file"),
    )
    return pairs, summaries


@register("snapshot_from_payload", """
SELECT event_type AS pair_id, event_type || '_idr' AS ticker_id,
       upper(event_type[1]) || event_type[2:] AS asset_name,
       value AS buy_price, value AS sell_price, value AS high_price, value AS low_price, value AS last_price,
       CAST(json_extract_string(props, '$.k') AS DOUBLE) AS price_24h_ago,
       CASE WHEN event_type <> 'error' THEN CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS price_7d_ago,
       CAST(user_id AS DOUBLE) AS volume_asset, value AS volume_idr,
       date_trunc('second', ts) AS source_timestamp, ts AS captured_at,
       strftime(ts, '%Y-%m-%d') AS ingestion_date,
       'landing/summaries_' || strftime(ts, '%Y%m%dT%H%M%SZ') || '.json' AS source_file,
       CAST(event_id AS VARCHAR) AS run_id
FROM events""")
def snapshot_from_payload(spark, sf_dir):
    pairs, summaries = _payloads(spark, sf_dir)
    return naive(snapshot.build_market_snapshot(pairs, summaries), "source_timestamp", "captured_at")


@register("snapshot_document_metrics", """
WITH s AS (
  SELECT CAST(event_id AS VARCHAR) AS run_id, value, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS day,
         CASE WHEN event_type <> 'error' THEN CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS week
  FROM events)
SELECT run_id, round(value - day, 6) AS price_change_24h,
       round(CASE WHEN day > 0 THEN (value - day) / day * 100 END, 6) AS price_change_24h_pct,
       round(value - week, 6) AS price_change_7d,
       round(CASE WHEN week > 0 THEN (value - week) / week * 100 END, 6) AS price_change_7d_pct,
       CAST(0 AS DOUBLE) AS spread, CAST(0 AS DOUBLE) AS spread_pct, CAST(1 AS BIGINT) AS volume_rank
FROM s""")
def snapshot_document_metrics(spark, sf_dir):
    """Gold metrics where each run is one document with one ticker."""
    gold = snapshot.build_market_metrics(snapshot.build_market_snapshot(*_payloads(spark, sf_dir)))
    names = ["price_change_24h", "price_change_24h_pct", "price_change_7d", "price_change_7d_pct",
             "spread", "spread_pct"]
    return gold.select("run_id", *[F.round(n, 6).alias(n) for n in names], "volume_rank")


def silver_by_day(spark, sf_dir) -> DataFrame:
    """Silver frame whose run is a whole day of quotes."""
    k = F.get_json_object("props", "$.k").cast("double")
    value = F.col("value")
    return src.table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("pair_id"),
        F.concat("event_type", F.lit("_IDR")).alias("ticker_id"),
        F.col("event_type").alias("asset_name"),
        k.alias("buy_price"), value.alias("sell_price"), value.alias("high_price"), k.alias("low_price"),
        value.alias("last_price"), k.alias("price_24h_ago"), F.col("user_id").cast("double").alias("price_7d_ago"),
        F.col("user_id").cast("double").alias("volume_asset"),
        F.when(F.col("event_type") != "error", value).alias("volume_idr"),
        F.col("ts").alias("source_timestamp"), F.col("ts").alias("captured_at"),
        fx.ingestion_date("ts").alias("ingestion_date"),
        F.lit("landing").alias("source_file"),
        fx.ingestion_date("ts").alias("run_id"),
    )


SILVER_BY_DAY = """silver AS (
  SELECT CAST(event_id AS VARCHAR) AS pair_id, event_type || '_IDR' AS ticker_id, event_type AS asset_name,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS buy_price, value AS sell_price, value AS high_price,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS low_price, value AS last_price,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS price_24h_ago, CAST(user_id AS DOUBLE) AS price_7d_ago,
         CAST(user_id AS DOUBLE) AS volume_asset, CASE WHEN event_type <> 'error' THEN value END AS volume_idr,
         ts AS captured_at, strftime(ts, '%Y-%m-%d') AS run_id
  FROM events)"""

GOLD_BY_DAY = SILVER_BY_DAY + """,
gold AS (
  SELECT *,
         last_price - price_24h_ago AS price_change_24h,
         CASE WHEN price_24h_ago > 0 THEN (last_price - price_24h_ago) / price_24h_ago * 100 END AS price_change_24h_pct,
         last_price - price_7d_ago AS price_change_7d,
         CASE WHEN price_7d_ago > 0 THEN (last_price - price_7d_ago) / price_7d_ago * 100 END AS price_change_7d_pct,
         sell_price - buy_price AS spread,
         CASE WHEN buy_price > 0 THEN (sell_price - buy_price) / buy_price * 100 END AS spread_pct,
         CASE WHEN volume_idr IS NOT NULL
              THEN dense_rank() OVER (PARTITION BY run_id ORDER BY volume_idr DESC NULLS LAST) END AS volume_rank
  FROM silver)"""


@register("snapshot_metrics", q.with_ctes(GOLD_BY_DAY, """
SELECT pair_id, run_id, captured_at, last_price, round(price_change_24h, 6) AS price_change_24h,
       round(price_change_24h_pct, 6) AS price_change_24h_pct, round(price_change_7d, 6) AS price_change_7d,
       round(price_change_7d_pct, 6) AS price_change_7d_pct, round(spread, 6) AS spread,
       round(spread_pct, 6) AS spread_pct, volume_rank
FROM gold"""))
def snapshot_metrics(spark, sf_dir):
    """Changes, spread and rank where a run is a whole day of any size."""
    gold = snapshot.build_market_metrics(silver_by_day(spark, sf_dir), one_document_per_run=False)
    names = ["price_change_24h", "price_change_24h_pct", "price_change_7d", "price_change_7d_pct",
             "spread", "spread_pct"]
    return gold.select("pair_id", "run_id", "captured_at", "last_price",
                       *[F.round(n, 6).alias(n) for n in names], "volume_rank")


@register("latest_snapshot", q.with_ctes(SILVER_BY_DAY, """
SELECT pair_id, ticker_id, last_price, volume_idr, captured_at, run_id FROM silver
WHERE run_id = (SELECT max(run_id) FROM silver)"""))
def latest_snapshot(spark, sf_dir):
    return latest_only(silver_by_day(spark, sf_dir), "run_id").select(
        "pair_id", "ticker_id", "last_price", "volume_idr", "captured_at", "run_id")


@register("payload_profile", """
SELECT CAST(event_id AS VARCHAR) AS run_id, CAST(1 AS BIGINT) AS tickers, event_type || '_idr' AS ticker_key,
       CAST(1 AS BIGINT) AS prices_24h, json_extract_string(props, '$.k') AS price_value
FROM events""")
def payload_profile(spark, sf_dir):
    _, summaries = _payloads(spark, sf_dir)
    return summaries.select(
        "run_id", fx.section_profile("tickers").alias("t"), fx.section_profile("prices_24h").alias("p")
    ).select("run_id", F.col("t.entries").alias("tickers"), F.col("t.sample_key").alias("ticker_key"),
             F.col("p.entries").alias("prices_24h"), F.col("p.sample_value").alias("price_value"))


# --- tabular Bronze and staging ----------------------------------------------
@register("stg_summaries", """
SELECT event_type AS pair_id, event_type || '_IDR' AS ticker_id,
       CAST(value AS DECIMAL(28,8)) AS last_price, CAST(value AS DECIMAL(28,8)) AS buy_price,
       CAST(value AS DECIMAL(28,8)) AS sell_price, CAST(value AS DECIMAL(28,8)) AS high_price,
       CAST(value AS DECIMAL(28,8)) AS low_price, CAST(user_id AS DECIMAL(28,8)) AS volume_asset,
       CAST(value AS DECIMAL(28,8)) AS volume_idr, date_trunc('second', ts) AS captured_at,
       'summaries_' || strftime(ts, '%Y%m%dT%H%M%SZ') AS run_id
FROM events""")
def stg_summaries(spark, sf_dir):
    pairs, summaries = _payloads(spark, sf_dir)
    return naive(staging.stage("summaries", snapshot.tabular_summaries(summaries, pairs)).drop("ingested_at"),
                 "captured_at")


@register("stg_pairs", """
SELECT CAST(p_partkey AS VARCHAR) AS pair_id, p_type || '_' || CAST(p_partkey AS VARCHAR) AS ticker_id,
       p_name AS asset_name, upper(p_brand) AS base_currency, upper(p_type) AS quote_currency,
       CAST(NULL AS INTEGER) AS price_decimal_places, CAST(NULL AS DECIMAL(18,8)) AS min_price,
       CAST(NULL AS DECIMAL(18,8)) AS max_price, CAST(NULL AS DECIMAL(18,8)) AS min_volume,
       TIMESTAMP '2026-08-24 00:00:00' AS created_at, 'pairs_20260824T000000Z' AS run_id
FROM part""")
def stg_pairs(spark, sf_dir):
    payload = src.table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("id"),
        F.concat_ws("_", "p_type", F.col("p_partkey").cast("string")).alias("ticker_id"),
        F.col("p_name").alias("traded_currency_unit"), F.col("p_brand").alias("base_currency"),
        F.col("p_type").alias("traded_currency"),
        F.lit(dataset_root("landing", "exchange", "pairs") + "/pairs_20260824T000000Z.json").alias("source_file"),
    )
    return naive(staging.stage("pairs", snapshot.tabular_pairs(payload)).drop("captured_at"), "created_at")


@register("stg_users", """
SELECT CAST(c_custkey AS VARCHAR) AS user_id, c_name || '@example.com' AS email, c_name AS full_name,
       c_acctbal > 0 AS is_active, TIMESTAMP '2024-01-01' AS created_at, TIMESTAMP '2024-01-02' AS updated_at
FROM customer""")
def stg_users(spark, sf_dir):
    raw = src.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), F.concat("c_name", F.lit("@example.com")).alias("email"),
        F.col("c_name").alias("full_name"), (F.col("c_acctbal") > 0).cast("string").alias("is_active"),
        F.lit("2024-01-01T00:00:00Z").alias("created_at"), F.lit("2024-01-02T00:00:00Z").alias("updated_at"),
    )
    return naive(staging.stage("users", raw).drop("captured_at"), "created_at", "updated_at")


@register("stg_accounts", """
SELECT CAST(c_custkey AS VARCHAR) AS account_id, CAST(c_custkey AS VARCHAR) AS user_id, c_mktsegment AS currency,
       CAST(c_acctbal AS DECIMAL(18,8)) AS balance, CAST(c_nationkey AS DECIMAL(18,8)) AS locked_balance,
       TIMESTAMP '2024-01-01' AS created_at, TIMESTAMP '2024-01-02' AS updated_at
FROM customer""")
def stg_accounts(spark, sf_dir):
    raw = src.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("account_id"), F.col("c_custkey").alias("user_id"),
        F.col("c_mktsegment").alias("currency"), F.col("c_acctbal").cast("string").alias("balance"),
        F.col("c_nationkey").alias("locked_balance"),
        F.lit("2024-01-01T00:00:00Z").alias("created_at"), F.lit("2024-01-02T00:00:00Z").alias("updated_at"),
    )
    return naive(staging.stage("accounts", raw).drop("captured_at"), "created_at", "updated_at")


@register("stg_assets", """
SELECT CAST(p_partkey AS VARCHAR) AS asset_id, p_brand || '-' || CAST(p_partkey AS VARCHAR) AS symbol,
       p_name AS name, CAST(p_size AS INTEGER) AS precision, TIMESTAMP '2024-01-01' AS created_at
FROM part""")
def stg_assets(spark, sf_dir):
    raw = src.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("asset_id"),
        F.concat_ws("-", "p_brand", F.col("p_partkey").cast("string")).alias("symbol"),
        F.col("p_name").alias("name"), F.col("p_size").cast("string").alias("precision"),
        F.lit("2024-01-01T00:00:00Z").alias("created_at"),
    )
    return naive(staging.stage("assets", raw).drop("captured_at"), "created_at")


@register("stg_orders", q.with_ctes(q.ORDERS, """
SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(user_id AS VARCHAR) AS user_id, pair, order_type, price, quantity,
       filled_quantity, status, created_at, updated_at FROM ord"""))
def stg_orders(spark, sf_dir):
    return naive(staging.stage("orders", src.orders(spark, sf_dir)).drop("captured_at"), "created_at", "updated_at")


@register("stg_trades", q.with_ctes(q.TRADES, """
SELECT CAST(trade_id AS VARCHAR) AS trade_id, CAST(order_id AS VARCHAR) AS order_id, price, quantity, taker_side,
       executed_at FROM trd"""))
def stg_trades(spark, sf_dir):
    return naive(staging.stage("trades", src.trades(spark, sf_dir)).drop("captured_at"), "executed_at")


@register("stg_transactions", """
SELECT CAST(o_orderkey AS VARCHAR) AS transaction_id, CAST(o_custkey AS VARCHAR) AS account_id,
       CAST(o_totalprice AS DECIMAL(18,8)) AS amount, o_orderpriority AS type, o_orderstatus AS status,
       o_orderdate AS created_at
FROM orders""")
def stg_transactions(spark, sf_dir):
    raw = src.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("transaction_id"), F.col("o_custkey").alias("account_id"),
        F.col("o_totalprice").alias("amount"), F.col("o_orderpriority").alias("type"),
        F.col("o_orderstatus").alias("status"), F.col("o_orderdate").alias("created_at"),
    )
    return naive(staging.stage("transactions", raw).drop("captured_at"), "created_at")


def event_documents(spark, sf_dir, **fields) -> DataFrame:
    """Events as documents: ``_id, event, context, ingested_at`` with context as text."""
    at = fx.iso_text(F.col("ts").cast("timestamp"))
    context = {"user_id": F.col("user_id").cast("string"), "session_id": F.get_json_object("props", "$.k"),
               "timestamp": at, **fields}
    return src.table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("_id"), F.col("event_type").alias("event"),
        F.to_json(F.struct(*[c.alias(n) for n, c in context.items()])).alias("context"),
        at.alias("ingested_at"),
    )


@register("json_flatten", """
SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, CAST(user_id AS VARCHAR) AS user_id,
       json_extract_string(props, '$.k') AS session_id, date_trunc('second', ts) AS event_timestamp,
       value AS property_value, date_trunc('second', ts) AS ingested_at
FROM events""")
def json_flatten(spark, sf_dir):
    staged = staging.stage_user_events(event_documents(spark, sf_dir, value=F.col("value")))
    return naive(
        staged.withColumn("property_value", F.variant_get("event_properties", "$.value", "double"))
        .drop("event_properties", "captured_at"),
        "event_timestamp", "ingested_at",
    )


@register("ticker_events_flatten", """
SELECT CAST(event_id AS VARCHAR) AS event_id, event_type AS pair_id, event_type || '_idr' AS ticker_id,
       value AS last_price, value AS buy_price, value AS sell_price, value AS high_24h, value AS low_24h,
       CAST(user_id AS DOUBLE) AS volume_idr, date_trunc('second', ts) AS event_timestamp,
       date_trunc('second', ts) AS ingested_at
FROM events""")
def ticker_events_flatten(spark, sf_dir):
    value = F.col("value")
    docs = event_documents(
        spark, sf_dir, pair=F.col("event_type"), ticker_id=F.concat("event_type", F.lit("_idr")),
        last_price=value, buy_price=value, sell_price=value, high_24h=value, low_24h=value,
        volume_idr=F.col("user_id").cast("double"),
    )
    return naive(staging.stage_ticker_events(docs).drop("captured_at"), "event_timestamp", "ingested_at")


@register("orderbook_levels", """
WITH levels AS (SELECT unnest(range(1, 11)) AS level),
books AS (SELECT o_orderpriority AS pair_id, CAST(o_totalprice AS DECIMAL(18,2)) AS mid, o_orderkey FROM orders),
quotes AS (
  SELECT pair_id, 'bid' AS side, level, mid - level AS price, o_orderkey + level AS quantity FROM books, levels
  UNION ALL
  SELECT pair_id, 'ask', level, mid + level, o_orderkey + level FROM books, levels)
SELECT pair_id, side, CAST(level AS INTEGER) AS level, count(*) AS quotes,
       CAST(min(price) AS DECIMAL(18,2)) AS min_price, CAST(max(price) AS DECIMAL(18,2)) AS max_price,
       CAST(sum(price) AS DECIMAL(38,2)) AS sum_price, CAST(sum(quantity) AS DECIMAL(38,2)) AS sum_quantity
FROM quotes GROUP BY pair_id, side, level""")
def orderbook_levels(spark, sf_dir):
    """Ten bid and ask levels around each order's price, flattened and summed up."""
    mid, key = F.col("o_totalprice"), F.col("o_orderkey").cast("double")

    def side(sign: int):
        return F.transform(F.sequence(F.lit(1), F.lit(10)),
                           lambda i: F.array(mid + sign * i, key + i))

    books = src.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("_id"),
        F.to_json(F.struct(F.col("o_orderpriority").alias("pair"), side(-1).alias("bids"),
                           side(1).alias("asks"))).alias("context"),
        F.lit("2024-01-01T00:00:00Z").alias("ingested_at"),
    )
    money = "decimal(18,2)"
    return staging.stage_orderbooks(books).groupBy("pair_id", "side", "level").agg(
        F.count(F.lit(1)).alias("quotes"),
        F.min(F.col("price").cast(money)).alias("min_price"), F.max(F.col("price").cast(money)).alias("max_price"),
        F.sum(F.col("price").cast(money)).cast("decimal(38,2)").alias("sum_price"),
        F.sum(F.col("quantity").cast(money)).cast("decimal(38,2)").alias("sum_quantity"),
    )


@register("clean_staging", """
WITH ranked AS (
  SELECT user_id, trim('  ' || event_type || ' ') AS event_type, value, ts,
         row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM events)
SELECT user_id, event_type, value, ts FROM ranked WHERE rn = 1""")
def clean_staging(spark, sf_dir):
    raw = src.table(spark, sf_dir, "events").select(
        "user_id", F.concat(F.lit("  "), "event_type", F.lit(" ")).alias("event_type"), "value", "ts")
    return staging.clean(raw, ["user_id"], "ts")


@register("dedup_keep_first", """
WITH ranked AS (
  SELECT l_orderkey, l_linenumber, l_shipdate, l_extendedprice, l_partkey, l_suppkey,
         row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                            ORDER BY l_shipdate, l_extendedprice, l_partkey, l_suppkey) AS rn
  FROM lineitem)
SELECT l_orderkey, l_linenumber, l_shipdate, l_extendedprice, l_partkey, l_suppkey FROM ranked WHERE rn = 1""")
def dedup_keep_first(spark, sf_dir):
    lines = src.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice", "l_partkey", "l_suppkey")
    return keep_first(lines, ["l_orderkey", "l_linenumber"],
                      ["l_shipdate", "l_extendedprice", "l_partkey", "l_suppkey"])


@register("scalar_functions", """
SELECT event_id,
       value AS parsed, CAST(NULL AS DOUBLE) AS not_a_number, date_trunc('second', ts) AS from_epoch,
       CAST(NULL AS TIMESTAMP) AS bad_epoch,
       round(value / (1 + CAST(json_extract_string(props, '$.k') AS DOUBLE) / 100), 6) AS prior_price,
       TRUE AS near, value = 1 AS far, strftime(ts, '%Y-%m-%d') AS ingestion_date, strftime(ts, '%H') AS hour,
       strftime(ts, '%Y%m%dT%H%M%SZ') AS stamp, 'pairs_' || strftime(ts, '%Y%m%dT%H%M%SZ') AS stem,
       date_trunc('second', ts) AS file_time, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_key,
       upper(event_type) AS upper_text, '' AS upper_null
FROM events""")
def scalar_functions(spark, sf_dir):
    ts = F.col("ts").cast("timestamp")
    path = F.concat(F.lit("landing/pairs_"), fx.run_stamp(ts), F.lit(".json"))
    df = src.table(spark, sf_dir, "events").select(
        "event_id",
        fx.to_double(F.col("value").cast("string")).alias("parsed"),
        fx.to_double("event_type").alias("not_a_number"),
        fx.epoch_to_timestamp(F.unix_seconds(ts).cast("string")).alias("from_epoch"),
        fx.epoch_to_timestamp("props").alias("bad_epoch"),
        F.round(fx.prior_price("value", F.get_json_object("props", "$.k")), 6).alias("prior_price"),
        fx.is_close("value", F.col("value") * (1 + 1e-7)).alias("near"),
        fx.is_close("value", F.lit(1.0)).alias("far"),
        fx.ingestion_date("ts").alias("ingestion_date"), fx.ingestion_hour("ts").alias("hour"),
        fx.run_stamp(ts).alias("stamp"), fx.file_stem(path).alias("stem"),
        fx.file_captured_at(path).alias("file_time"), fx.date_key("ts").alias("date_key"),
        F.upper(F.coalesce("event_type", F.lit(""))).alias("upper_text"),
        F.upper(F.coalesce(F.lit(None).cast("string"), F.lit(""))).alias("upper_null"),
    )
    return naive(df, "from_epoch", "bad_epoch", "file_time")


# --- star schema ---------------------------------------------------------------
# A first load up to the cut-off, then the whole batch: only absent rows come in.
MARKET_CUTOFF = "1998-01-01 00:00:00"
FACT_CUTOFF = "2024-01-15 00:00:00"


def _markets(spark, sf_dir) -> DataFrame:
    pair = F.col("l_partkey").cast("string")
    return src.table(spark, sf_dir, "lineitem").select(
        pair.alias("pair_id"), F.concat(pair, F.lit("_IDR")).alias("ticker_id"),
        F.col("l_linestatus").alias("asset_name"), F.col("l_shipdate").alias("captured_at"),
    )


def _before(df: DataFrame, cutoff: str) -> DataFrame:
    return df.where(F.col("captured_at") < F.lit(cutoff).cast("timestamp_ntz"))


def _empty_markets(spark) -> DataFrame:
    return spark.createDataFrame([], "market_key bigint, pair_id string, ticker_id string, asset_name string")


_MARKETS_SQL = f"""lines AS (
  SELECT CAST(l_partkey AS VARCHAR) AS pair_id, CAST(l_partkey AS VARCHAR) || '_IDR' AS ticker_id,
         l_linestatus AS asset_name, l_shipdate AS captured_at FROM lineitem),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY pair_id ORDER BY captured_at, ticker_id, asset_name) AS rn FROM lines),
first_lines AS (SELECT * FROM ranked WHERE rn = 1),
old_markets AS (
  SELECT row_number() OVER (ORDER BY pair_id) AS market_key, pair_id, ticker_id, asset_name
  FROM first_lines WHERE captured_at < TIMESTAMP '{MARKET_CUTOFF}'),
added AS (
  SELECT (SELECT coalesce(max(market_key), 0) FROM old_markets) + row_number() OVER (ORDER BY pair_id) AS market_key,
         pair_id, ticker_id, asset_name
  FROM first_lines WHERE pair_id NOT IN (SELECT pair_id FROM old_markets))"""


@register("dim_market", q.with_ctes(_MARKETS_SQL, """
SELECT market_key, pair_id, ticker_id, asset_name FROM old_markets
UNION ALL SELECT market_key, pair_id, ticker_id, asset_name FROM added"""))
def dim_market(spark, sf_dir):
    """Two loads into an empty market dimension."""
    gold = _markets(spark, sf_dir)
    first = star.new_markets(_before(gold, MARKET_CUTOFF), _empty_markets(spark))
    return first.unionByName(star.new_markets(gold, first))


@register("dim_date", """
SELECT DISTINCT CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS date_key, CAST(l_shipdate AS DATE) AS full_date,
       CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
       CAST(day(l_shipdate) AS INTEGER) AS day
FROM lineitem""")
def dim_date(spark, sf_dir):
    """Dates of a first load and those a second load adds."""
    gold = _markets(spark, sf_dir)
    first = star.date_dimension(_before(gold, MARKET_CUTOFF))
    return first.unionByName(star.new_dates(gold, first))


def _gold_by_type(spark, sf_dir) -> DataFrame:
    """Gold frame with one market per event type."""
    value = F.col("value")
    return src.table(spark, sf_dir, "events").select(
        F.col("event_type").alias("pair_id"), F.concat("event_type", F.lit("_IDR")).alias("ticker_id"),
        F.col("event_type").alias("asset_name"), F.col("ts").alias("captured_at"),
        F.col("event_id").cast("string").alias("run_id"),
        *[value.alias(c) for c in ("buy_price", "sell_price", "high_price", "low_price", "last_price")],
        *[F.col("user_id").cast("double").alias(c)
          for c in ("price_change_24h_pct", "price_change_7d_pct", "spread_pct")],
        value.alias("volume_asset"), value.alias("volume_idr"), F.col("event_id").alias("volume_rank"),
    )


def _star_by_type(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    gold = _gold_by_type(spark, sf_dir)
    dim = star.new_markets(gold, _empty_markets(spark))
    loaded = _before(gold, FACT_CUTOFF).join(dim.select("market_key", "pair_id"), "pair_id").select(
        "market_key", "captured_at")
    return gold, dim, loaded


_FACTS_SQL = """markets AS (
  SELECT row_number() OVER (ORDER BY event_type) AS market_key, event_type AS pair_id
  FROM (SELECT DISTINCT event_type FROM events)),
facts AS (
  SELECT m.market_key, m.pair_id, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_key, ts AS captured_at,
         CAST(event_id AS VARCHAR) AS run_id, value AS buy_price, value AS sell_price, value AS high_price,
         value AS low_price, value AS last_price, CAST(user_id AS DOUBLE) AS price_change_24h_pct,
         CAST(user_id AS DOUBLE) AS price_change_7d_pct, CAST(user_id AS DOUBLE) AS spread_pct,
         value AS volume_asset, value AS volume_idr, event_id AS volume_rank
  FROM events e JOIN markets m ON e.event_type = m.pair_id)"""


@register("fact_snapshot", q.with_ctes(_FACTS_SQL + f""",
loaded AS (SELECT market_key, captured_at FROM facts WHERE captured_at < TIMESTAMP '{FACT_CUTOFF}')""", """
SELECT f.* EXCLUDE (pair_id) FROM facts f
WHERE NOT EXISTS (SELECT 1 FROM loaded l WHERE l.market_key = f.market_key AND l.captured_at = f.captured_at)"""))
def fact_snapshot(spark, sf_dir):
    """Facts a second load adds after the first one up to the cut-off."""
    gold, dim, loaded = _star_by_type(spark, sf_dir)
    return star.new_facts(gold, dim, loaded, on_missing="raise")


@register("star_topn", q.with_ctes(_FACTS_SQL, """
SELECT market_key, pair_id, date_key, captured_at, run_id, last_price, price_change_24h_pct, spread_pct, volume_rank
FROM facts ORDER BY captured_at DESC, market_key LIMIT 10"""))
def star_topn(spark, sf_dir):
    """The ten newest facts with their market."""
    gold, dim, loaded = _star_by_type(spark, sf_dir)
    nothing = spark.createDataFrame([], loaded.schema)
    facts = star.new_facts(gold, dim, nothing)
    return star.latest_facts(facts, dim, 10)


@register("star_dim_head", q.with_ctes(_MARKETS_SQL, """
SELECT market_key, pair_id, ticker_id, asset_name FROM old_markets ORDER BY market_key LIMIT 10"""))
def star_dim_head(spark, sf_dir):
    """The first ten markets by key of the dimension that both loads fill."""
    return star.dim_market_head(dim_market(spark, sf_dir), 10)


_COUNTED = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@register("table_counts", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in _COUNTED))
def table_counts(spark, sf_dir):
    return star.row_counts({t: src.table(spark, sf_dir, t) for t in _COUNTED})


# --- incremental extraction -----------------------------------------------------
ORDER_MARK = "1998-06-01 00:00:00"
EVENT_MARK = "2024-01-20 12:00:00"


def _mark(text: str):
    return F.lit(text).cast("timestamp_ntz")


@register("incremental_slice", f"""
SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderdate > TIMESTAMP '{ORDER_MARK}'""")
def incremental_slice(spark, sf_dir):
    """Rows past the stored mark; the filter reaches the scan."""
    orders = src.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return tables.newer_than(orders, "o_orderdate", _mark(ORDER_MARK))


@register("incremental_marks", f"""
SELECT 'postgresql.orders' AS namespace, count(*) AS rows_extracted, max(o_orderdate) AS watermark_after
FROM orders WHERE o_orderdate > TIMESTAMP '{ORDER_MARK}'
UNION ALL SELECT 'postgresql.trades', count(*), max(l_shipdate) FROM lineitem WHERE l_shipdate > TIMESTAMP '{ORDER_MARK}'
UNION ALL SELECT 'mongodb.user_events', count(*), max(ts) FROM events WHERE ts > TIMESTAMP '{EVENT_MARK}'""")
def incremental_marks(spark, sf_dir):
    """Rows and new mark per dataset of one incremental run."""
    plan = [("postgresql.orders", "orders", "o_orderdate", ORDER_MARK),
            ("postgresql.trades", "lineitem", "l_shipdate", ORDER_MARK),
            ("mongodb.user_events", "events", "ts", EVENT_MARK)]
    parts = [
        tables.newer_than(src.table(spark, sf_dir, t), c, _mark(m))
        .agg(F.count(F.lit(1)).alias("rows_extracted"), F.max(c).alias("watermark_after"))
        .select(F.lit(n).alias("namespace"), "rows_extracted", "watermark_after")
        for n, t, c, m in plan
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _bronze(spark, sf_dir) -> dict[str, DataFrame]:
    """The nine source tables as Bronze holds them."""
    day = F.lit("2024-01-01T00:00:00Z")
    customer, part, orders = (src.table(spark, sf_dir, t) for t in ("customer", "part", "orders"))
    quotes = src.table(spark, sf_dir, "events").select(
        F.col("event_type").alias("pair"), *[F.col("value").alias(c) for c in ("last", "buy", "sell", "high", "low", "vol_idr")],
        F.col("user_id").alias("vol_coin"), F.col("ts").alias("created_at"), F.col("event_id").cast("string").alias("run_id"))
    return {f"bronze.{name}": df for name, df in {
        "users": customer.select(
            F.col("c_custkey").alias("user_id"), F.concat("c_name", F.lit("@example.com")).alias("email"),
            F.col("c_name").alias("full_name"), (F.col("c_acctbal") > 0).alias("is_active"),
            day.alias("created_at"), day.alias("updated_at")),
        "accounts": src.accounts(spark, sf_dir).select("*", day.alias("created_at"), day.alias("updated_at")),
        "assets": part.select(
            F.col("p_partkey").alias("asset_id"), F.col("p_brand").alias("symbol"), F.col("p_name").alias("name"),
            F.col("p_size").alias("precision"), day.alias("created_at")),
        "orders": src.orders(spark, sf_dir), "trades": src.trades(spark, sf_dir),
        "transactions": orders.select(
            F.col("o_orderkey").alias("transaction_id"), F.col("o_custkey").alias("account_id"),
            F.col("o_totalprice").alias("amount"), F.col("o_orderpriority").alias("type"),
            F.col("o_orderstatus").alias("status"), F.col("o_orderdate").alias("created_at")),
        "user_events": event_documents(spark, sf_dir), "summaries": quotes,
        "pairs": snapshot.tabular_pairs(part.select(
            F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("ticker_id"),
            F.col("p_name").alias("traded_currency_unit"), F.col("p_brand").alias("base_currency"),
            F.col("p_type").alias("traded_currency"),
            F.lit(dataset_root("landing", "exchange", "pairs") + "/pairs_20260824T000000Z.json").alias("source_file"))),
    }.items()}


#: What is summed to tell a view by: the table or CTE and its expression, and the view's column.
_VIEW_SUMS = {
    "staging.users": ("customer", "c_custkey", "user_id"),
    "staging.accounts": ("customer", "c_acctbal", "balance"),
    "staging.assets": ("part", "p_size", "precision"),
    "staging.orders": ("ord", "quantity", "quantity"),
    "staging.trades": ("trd", "price", "price"),
    "staging.transactions": ("orders", "o_totalprice", "amount"),
    "staging.user_events": ("events", "user_id", "user_id"),
    "staging.summaries": ("ticks", "last_price", "last_price"),
    "staging.pairs": ("part", "p_partkey", "pair_id"),
    "intermediate.daily_market": ("daily_market", "volume_asset", "volume_asset"),
    "intermediate.orders_trades": ("orders_trades", "trade_quantity", "trade_quantity"),
    "intermediate.daily_trading": ("daily_trading", "total_orders", "total_orders"),
    "intermediate.user_events_daily": ("events_daily", "active_users", "active_users"),
    "intermediate.user_trading_activity": ("active", "user_id", "user_id"),
}


@register("model_views", q.with_ctes(",\n".join([q.DAILY_MARKET, q.DAILY_TRADING, q.EVENTS_DAILY, q.ACTIVE]), " UNION ALL ".join(
    f"SELECT '{key}' AS model, count(*) AS n, CAST(sum(CAST({value} AS DECIMAL(28,8))) AS DECIMAL(38,8)) AS total FROM {table}"
    for key, (table, value, _) in _VIEW_SUMS.items())))
def model_views(spark, sf_dir):
    """All 14 models built from Bronze and read through the views of their layers: rows and one sum of each."""
    built = models.build(models.declared(F.lit("2024-01-02").cast("timestamp")), _bronze(spark, sf_dir))
    views = dict(zip(built, register_models(built), strict=True))
    out = None
    for key, (_, _, column) in _VIEW_SUMS.items():
        total = F.sum(F.col(column).cast("decimal(28,8)")).cast("decimal(38,8)")
        row = spark.table(views[key]).agg(F.count(F.lit(1)).alias("n"), total.alias("total")).select(
            F.lit(key).alias("model"), "n", "total")
        out = row if out is None else out.union(row)
    return out
