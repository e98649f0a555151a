"""Intermediate models at daily grain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from marketloom.functions import as_date, order_key


def _at(ticks: DataFrame, tie_break: Column | str | None) -> Column:
    """Order of the ticks; one fixed-width number if the tie-break is a whole number or absent."""
    if tie_break is None:
        return order_key("captured_at")
    tie = ticks.select(tie_break).schema[0].dataType
    return order_key("captured_at", tie_break, whole=isinstance(tie, IntegralType))


def market_states(ticks: DataFrame, tie_break: Column | str | None = None,
                  symbol: Column | str = "pair_id") -> DataFrame:
    """First and last price with their place in time, extremes and sums per date and symbol.

    States of parts of the ticks merge to the state of all of them. One hash
    aggregation with map-side partials: ticks are neither sorted nor shipped,
    and a symbol holding most of them shrinks to one row per map task. Only a
    tie-break that is no whole number needs a sort before the exchange.
    """
    symbol = F.col(symbol) if isinstance(symbol, str) else symbol
    return (
        ticks.select(
            as_date("captured_at").alias("date"), symbol.alias("symbol"), _at(ticks, tie_break).alias("_at"),
            "last_price", "high_price", "low_price", "volume_idr", "volume_asset",
        )
        .groupBy("date", "symbol")
        .agg(
            F.min("_at").alias("first_at"), F.min_by("last_price", "_at").alias("open_price"),
            F.max("_at").alias("last_at"), F.max_by("last_price", "_at").alias("close_price"),
            F.max("high_price").alias("high_price"), F.min("low_price").alias("low_price"),
            F.sum("volume_idr").alias("volume_idr"), F.sum("volume_asset").alias("volume_asset"),
        )
    )


def merge_market(states: DataFrame) -> DataFrame:
    """One state per date and symbol from any number of them."""
    return states.groupBy("date", "symbol").agg(
        F.min("first_at").alias("first_at"), F.min_by("open_price", "first_at").alias("open_price"),
        F.max("last_at").alias("last_at"), F.max_by("close_price", "last_at").alias("close_price"),
        F.max("high_price").alias("high_price"), F.min("low_price").alias("low_price"),
        F.sum("volume_idr").alias("volume_idr"), F.sum("volume_asset").alias("volume_asset"),
    )


def finish_market(states: DataFrame) -> DataFrame:
    """The daily market rows of merged states."""
    return states.select("date", "symbol", "open_price", "high_price", "low_price", "close_price",
                         "volume_idr", "volume_asset")


def daily_market(ticks: DataFrame, tie_break: Column | str | None = None,
                 symbol: Column | str = "pair_id") -> DataFrame:
    """Open, high, low, close and volumes per date and symbol.

    Open and close are the last prices of the first and the last tick;
    ``tie_break`` orders ticks captured at the same instant.
    """
    return finish_market(market_states(ticks, tie_break, symbol))


def daily_market_by_currency(ticks: DataFrame, pairs: DataFrame,
                             tie_break: Column | str | None = None) -> DataFrame:
    """Daily market at the grain of the pair's base currency.

    Ticks are first reduced to one state per date and pair; only those meet the
    pairs and are merged again, so the join never sees raw ticks.
    """
    currency = pairs.select(F.col("pair_id").alias("_pair"), "base_currency")
    states = market_states(ticks, tie_break)
    renamed = states.join(currency, states["symbol"] == F.col("_pair")).drop("symbol", "_pair")
    return finish_market(merge_market(renamed.withColumnRenamed("base_currency", "symbol")))


def _order_columns(orders: DataFrame) -> DataFrame:
    return orders.select(
        "order_id", "user_id", F.col("pair").alias("symbol"), "order_type",
        F.col("price").alias("order_price"), F.col("quantity").alias("order_quantity"),
        "filled_quantity", "status",
        F.col("created_at").alias("order_created_at"),
        F.col("updated_at").alias("order_updated_at"),
    )


def _trade_columns(trades: DataFrame) -> DataFrame:
    return trades.select(
        "trade_id", F.col("order_id").alias("_order_id"), F.col("price").alias("trade_price"),
        F.col("quantity").alias("trade_quantity"), "taker_side", "executed_at",
    )


def orders_trades(orders: DataFrame, trades: DataFrame) -> DataFrame:
    """Orders with their trades; an order without trades has one row.

    Written as matched rows plus unmatched orders. In an outer join only the
    preserved side can be split at run time, which would leave an order with
    a huge number of trades on one task; an inner join can split both sides.
    The second use of the orders reads the same exchange.
    """
    o, t = _order_columns(orders), _trade_columns(trades)
    keyed = o.where(o.order_id.isNotNull())
    matched = keyed.join(t, keyed.order_id == t._order_id, "inner").drop("_order_id")
    traded = t.select("_order_id").where("_order_id is not null").distinct()
    unmatched = keyed.join(traded, keyed.order_id == traded._order_id, "left_anti")
    keyless = o.where(o.order_id.isNull())
    return matched.unionByName(unmatched.unionByName(keyless), allowMissingColumns=True)


def daily_trading(orders: DataFrame, trades: DataFrame, dedup: bool = False,
                  unique_orders: bool = False) -> DataFrame:
    """Orders, completed orders and volumes per update date and symbol.

    An order with n trades counts its quantity n times in the buy and sell
    volumes, as the order-trade join fans it out; ``dedup=True`` counts it once.

    The fan-out itself is never built. Trades are reduced to one row per order
    on the way into the exchange, which disarms an order with very many trades,
    and the join reuses that partitioning. Orders are reduced to one row per
    order, date and symbol first, so distinct counts become plain counts and an
    id (or a missing id) shared by very many order rows stays small as well.
    ``unique_orders=True`` states that ids were checked to be unique and saves
    that step's exchange.
    """
    return daily_trading_of(orders, trade_sums(trades), dedup, unique_orders)


def trade_sums(trades: DataFrame) -> DataFrame:
    """Trades, trades with a quantity and quantity per order; sums of parts add up."""
    return trades.groupBy(F.col("order_id").alias("_order_id")).agg(
        F.count(F.lit(1)).alias("_trades"), F.count("quantity").alias("_sized"), F.sum("quantity").alias("_traded"))


def merge_trade_sums(sums: DataFrame) -> DataFrame:
    return sums.groupBy("_order_id").agg(*[F.sum(c).alias(c) for c in ("_trades", "_sized", "_traded")])


def daily_trading_of(orders: DataFrame, per_order: DataFrame, dedup: bool = False,
                     unique_orders: bool = False) -> DataFrame:
    """``daily_trading`` from the sums of each order's trades."""
    def side(order_type: str) -> Column:
        return F.when(F.col("order_type") == order_type, F.col("quantity")).otherwise(F.lit(0))

    filled = F.when(F.col("status") == "filled", F.lit(1)).otherwise(F.lit(0))
    placed = orders.select(
        "order_id", as_date("updated_at").alias("date"), F.col("pair").alias("symbol"),
        filled.alias("_filled"), side("buy").alias("_buy"), side("sell").alias("_sell"),
        F.lit(1).cast("bigint").alias("_rows"),
    ).where(F.col("date").isNotNull())
    if not unique_orders:
        placed = placed.groupBy("order_id", "date", "symbol").agg(
            F.max("_filled").alias("_filled"), F.sum("_buy").alias("_buy"),
            F.sum("_sell").alias("_sell"), F.sum("_rows").alias("_rows"),
        )

    def times(amount: str, count: Column) -> Column:
        # 24 + 13 + 1 digits fit a decimal without giving up its 8 places.
        return F.col(amount).cast("decimal(24,8)") * count.cast("decimal(13,0)")

    copies = F.lit(1) if dedup else F.coalesce(F.col("_trades"), F.lit(1))
    has_id = F.col("order_id").isNotNull()
    return (
        placed.join(per_order, F.col("order_id") == F.col("_order_id"), "left")
        .groupBy("date", "symbol")
        .agg(
            F.count("order_id").alias("total_orders"),
            F.count_if(has_id & (F.col("_filled") == 1)).alias("completed_orders"),
            F.sum(times("_buy", copies)).alias("buy_volume"),
            F.sum(times("_sell", copies)).alias("sell_volume"),
            F.sum(times("_traded", F.col("_rows"))).alias("trading_volume"),
            F.sum(F.col("_sized") * F.col("_rows")).alias("_sized"),
        )
        .select(
            "date", "symbol", "total_orders", "completed_orders", "buy_volume", "sell_volume",
            "trading_volume",
            F.when(F.col("_sized") > 0, F.col("trading_volume").cast("double") / F.col("_sized"))
            .alias("avg_trade_size"),
        )
    )


def event_states(events: DataFrame, date_from: str = "ingested_at") -> DataFrame:
    """Event counts per date and user; states of parts of the events merge."""
    kind = F.col("event_type")
    return (
        events.select(as_date(date_from).alias("date"), "user_id", "event_type")
        .where(F.col("date").isNotNull())
        .groupBy("date", "user_id")
        .agg(
            F.count_if(kind == "market_view").alias("market_views"),
            F.count_if(kind.isin("order_created", "order_updated")).alias("order_events"),
            F.count_if(kind == "login").alias("login_events"),
        )
    )


_EVENT_COUNTS = ("market_views", "order_events", "login_events")


def merge_events(states: DataFrame) -> DataFrame:
    """One state per date and user from any number of them."""
    return states.groupBy("date", "user_id").agg(*[F.sum(c).alias(c) for c in _EVENT_COUNTS])


def finish_events(states: DataFrame) -> DataFrame:
    """The daily rows of merged states: each known user counts once."""
    return states.groupBy("date").agg(
        F.count("user_id").alias("active_users"), *[F.sum(c).alias(c) for c in _EVENT_COUNTS])


def user_events_daily(events: DataFrame, date_from: str = "ingested_at") -> DataFrame:
    """Active users and event counts per date.

    The date is that of ingestion, so late events are never lost to a closed
    day; pass ``date_from="event_timestamp"`` for the date of the event.
    """
    return finish_events(event_states(events, date_from))


def user_trading_activity(orders: DataFrame, trades: DataFrame, events: DataFrame) -> DataFrame:
    """Orders, trades and events per date and user, zero where a source has none.

    The three sources are stacked and aggregated once: the full outer join of
    three daily aggregates needs the same rows shuffled up to three times. A
    null user never joins, so such rows stay apart per source (``_apart``).
    """
    null_count = F.lit(None).cast("bigint")
    null_volume = F.lit(None).cast("decimal(18,8)")

    def source(df: DataFrame, name: str, at: str, **measures: Column) -> DataFrame:
        blank = {"total_orders": null_count, "completed_orders": null_count,
                 "total_trades": null_count, "trading_volume": null_volume,
                 "total_events": null_count}
        cols = {**blank, **measures}
        return df.select(
            as_date(at).alias("date"), "user_id",
            F.when(F.col("user_id").isNull(), F.lit(name)).alias("_apart"),
            *[c.alias(n) for n, c in cols.items()],
        ).where(F.col("date").isNotNull())

    def one_if(condition: Column) -> Column:
        return F.when(condition, F.lit(1)).otherwise(F.lit(0)).cast("bigint")

    placed = source(
        orders, "orders", "updated_at",
        total_orders=one_if(F.col("order_id").isNotNull()),
        completed_orders=one_if(F.coalesce(F.col("status") == "filled", F.lit(False))),
    )
    owner = orders.select(F.col("order_id").alias("_order_id"), "user_id")
    executed = source(
        trades.join(owner, trades["order_id"] == F.col("_order_id"), "inner"),
        "trades", "executed_at",
        total_trades=one_if(F.col("trade_id").isNotNull()),
        trading_volume=F.col("quantity").cast("decimal(18,8)"),
    )
    seen = source(
        events.where(F.col("user_id").isNotNull()), "events", "ingested_at",
        total_events=F.lit(1).cast("bigint"),
    )
    measures = ["total_orders", "completed_orders", "total_trades", "trading_volume", "total_events"]
    return (
        placed.unionByName(executed).unionByName(seen)
        .groupBy("date", "user_id", "_apart")
        .agg(*[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in measures])
        .drop("_apart")
    )
