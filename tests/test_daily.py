from datetime import date, datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from marketloom.plans import daily, marts, staging


def ts(text):
    return datetime.fromisoformat(text)


TICK = ("pair_id string, captured_at timestamp, last_price decimal(28,8), high_price decimal(28,8), "
        "low_price decimal(28,8), volume_idr decimal(28,8), volume_asset decimal(28,8), run_id string")


def tick(at, last, high=None, low=None, vol=1, pair="btc", run="r"):
    d = lambda v: None if v is None else D(v)
    return (pair, ts(at), d(last), d(high or last), d(low or last), d(vol), d(vol), run)


def test_daily_market(spark):
    df = spark.createDataFrame([
        tick("2026-01-01T12:00", 15, 16, 11, 2), tick("2026-01-01T09:00", 10, 12, 9, 1),
        tick("2026-01-01T18:00", 14, 17, 8, 3)], TICK)
    r = daily.daily_market(df).first()
    assert [float(x) for x in (r.open_price, r.high_price, r.low_price, r.close_price, r.volume_idr)] == [10, 17, 8, 14, 6]


def test_daily_market_ties_follow_the_tie_break(spark):
    rows = [tick("2026-01-01T09:00", p, run=run) for p, run in ((3, "b"), (1, "a"), (2, "c"))]
    for order in (rows, rows[::-1]):
        r = daily.daily_market(spark.createDataFrame(order, TICK), "run_id").first()
        assert (float(r.open_price), float(r.close_price)) == (1, 2)


def test_daily_market_by_currency_merges_pairs(spark):
    df = spark.createDataFrame([
        tick("2026-01-01T09:00", 10, pair="a"), tick("2026-01-01T08:00", 7, pair="b"),
        tick("2026-01-01T11:00", 9, pair="a"), tick("2026-01-01T08:00", 1, pair="unlisted")], TICK)
    pairs = spark.createDataFrame([("a", "X"), ("b", "X")], "pair_id string, base_currency string")
    r = daily.daily_market_by_currency(df, pairs).collect()
    assert len(r) == 1
    assert [float(x) for x in (r[0].open_price, r[0].high_price, r[0].close_price, r[0].volume_idr)] == [7, 10, 9, 3]


def test_change_is_against_previous_available_day(spark):
    df = spark.createDataFrame([tick("2026-01-01T09:00", 100), tick("2026-01-03T09:00", 110)], TICK)
    rows = marts.market_daily(daily.daily_market(df)).orderBy("date").collect()
    assert [r.price_change_pct for r in rows] == [None, pytest.approx(10.0)]


def test_change_7d_needs_the_exact_day(spark):
    df = spark.createDataFrame([tick("2026-01-01T09:00", 100), tick("2026-01-08T09:00", 120),
                                tick("2026-01-09T09:00", 120)], TICK)
    rows = marts.change_7d(daily.daily_market(df)).orderBy("date").collect()
    assert [r.price_change_7d_pct for r in rows] == [None, pytest.approx(20.0), None]


ORDER = ("order_id string, user_id string, pair string, order_type string, price decimal(18,8), "
         "quantity decimal(18,8), filled_quantity decimal(18,8), status string, created_at timestamp, updated_at timestamp")
TRADE = ("trade_id string, order_id string, price decimal(18,8), quantity decimal(18,8), taker_side string, "
         "executed_at timestamp")
EVENT = "event_id string, event_type string, user_id string, ingested_at timestamp, event_timestamp timestamp"


def order(oid, user="u", kind="buy", qty=5, status="filled", at="2026-01-01T10:00"):
    when = ts(at) if at else None
    return (oid, user, "btc", kind, D(1), D(qty), D(qty), status, when, when)


def trade(tid, oid, qty, at="2026-01-01T11:00"):
    return (tid, oid, D(1), None if qty is None else D(qty), "buy", ts(at))


def test_daily_trading_fans_out(spark):
    orders = spark.createDataFrame([order("O1"), order("O2", kind="sell", qty=4, status="open")], ORDER)
    trades = spark.createDataFrame([trade("t1", "O1", 2), trade("t2", "O1", 3)], TRADE)
    r = daily.daily_trading(orders, trades).first()
    assert (r.total_orders, r.completed_orders) == (2, 1)
    assert [float(x) for x in (r.buy_volume, r.sell_volume, r.trading_volume, r.avg_trade_size)] == [10, 4, 5, 2.5]
    assert float(daily.daily_trading(orders, trades, dedup=True).first().buy_volume) == 5


def brute_daily_trading(spark, orders, trades):
    daily.orders_trades(orders, trades).createOrReplaceTempView("ot")
    return spark.sql("""
        SELECT cast(order_updated_at AS date) AS date, symbol, count(DISTINCT order_id) AS total_orders,
               count(DISTINCT CASE WHEN status = 'filled' THEN order_id END) AS completed_orders,
               sum(CASE WHEN order_type = 'buy' THEN order_quantity ELSE 0 END) AS buy_volume,
               sum(CASE WHEN order_type = 'sell' THEN order_quantity ELSE 0 END) AS sell_volume,
               sum(trade_quantity) AS trading_volume
        FROM ot WHERE cast(order_updated_at AS date) IS NOT NULL GROUP BY 1, 2""")


def test_daily_trading_equals_the_join_on_odd_rows(spark):
    """Repeated and null order ids, null quantities, null dates, orphans."""
    orders = spark.createDataFrame([
        order("A"), order("A", qty=7), order("A", qty=1, status="open"), order(None, qty=3), order(None, qty=2),
        order("B", kind="sell", at="2026-01-02T00:00"), order("C", at=None), order("D", kind="limit")], ORDER)
    trades = spark.createDataFrame([trade("1", "A", 2), trade("2", "A", None), trade("3", "B", None),
                                    trade("4", None, 9), trade("5", "Z", 9), trade("6", "C", 9)], TRADE)
    got = daily.daily_trading(orders, trades)
    want = brute_daily_trading(spark, orders, trades)
    key = lambda r: (r.date, r.symbol)
    assert [tuple(r)[:7] for r in sorted(got.collect(), key=key)] == [tuple(r) for r in sorted(want.collect(), key=key)]


@pytest.mark.parametrize("unique", [True, False])
def test_daily_trading_keeps_eight_decimals(spark, unique):
    orders = spark.createDataFrame([order("A", qty="0.12345678"), order("B", kind="sell", qty="5.00000001")], ORDER)
    trades = spark.createDataFrame([trade(str(i), "A", "0.00000001") for i in range(3)], TRADE)
    r = daily.daily_trading(orders, trades, unique_orders=unique).first()
    assert (r.buy_volume, r.sell_volume, r.trading_volume) == (D("0.37037034"), D("5.00000001"), D("0.00000003"))


def test_orders_trades_keeps_untraded_and_keyless_orders(spark):
    orders = spark.createDataFrame([order("A"), order("B"), order(None)], ORDER)
    trades = spark.createDataFrame([trade("1", "A", 2), trade("2", "A", 3), trade("3", "Z", 1), trade("4", None, 1)], TRADE)
    got = sorted((r.order_id or "", r.trade_id or "") for r in daily.orders_trades(orders, trades).collect())
    assert got == [("", ""), ("A", "1"), ("A", "2"), ("B", "")]


def event(kind, user, at="2026-01-01T10:00", seen=None):
    return ("e", kind, user, ts(at), ts(seen or at))


def test_user_events_daily(spark):
    df = spark.createDataFrame([event("market_view", "u1"), event("login", "u1"), event("order_created", "u2"),
                                event("order_updated", None)], EVENT)
    r = daily.user_events_daily(df).first()
    assert tuple(r)[1:] == (2, 1, 2, 1)


def test_event_date_is_a_choice(spark):
    df = spark.createDataFrame([event("login", "u", "2026-01-02T00:00", "2026-01-01T23:59")], EVENT)
    assert daily.user_events_daily(df).first().date == date(2026, 1, 2)
    assert daily.user_events_daily(df, "event_timestamp").first().date == date(2026, 1, 1)


def test_user_trading_activity(spark):
    orders = spark.createDataFrame([order("A", "a"), order("N", None)], ORDER)
    trades = spark.createDataFrame([trade("1", "N", 2)], TRADE)
    events = spark.createDataFrame([event("login", "b"), event("login", None)], EVENT)
    rows = sorted((r.user_id or "", r.total_orders, r.total_trades, float(r.trading_volume), r.total_events)
                  for r in daily.user_trading_activity(orders, trades, events).collect())
    # A null user never joins: its orders and its trades stay two rows.
    assert rows == [("", 0, 1, 2.0, 0), ("", 1, 0, 0.0, 0), ("a", 1, 0, 0.0, 0), ("b", 0, 0, 0.0, 1)]


def test_business_metrics_left_and_full(spark):
    d = date(2026, 1, 1)
    market = spark.createDataFrame([(d, "btc", 1.0, 2.0, None)],
                                   "date date, symbol string, close_price double, volume_idr double, price_change_pct double")
    trading = spark.createDataFrame([(d, "eth", 3.0, 4)], "date date, symbol string, trading_volume double, total_orders bigint")
    activity = spark.createDataFrame([(d, 5, 6)], "date date, active_users bigint, market_views bigint")
    rows = marts.business_metrics(market, trading, activity).collect()
    assert [(r.symbol, r.trading_volume, r.active_users) for r in rows] == [("btc", None, 5)]
    full = marts.business_metrics(market, trading, activity, full=True).collect()
    assert sorted((r.symbol, r.active_users) for r in full) == [("btc", 5), ("eth", 5)]


def test_clean_is_stable_and_trims(spark):
    rows = [("k", " a ", 1), ("k", "b", 2), ("k", "c", 2), ("m", " x", 0)]
    ddl = "id string, name string, at bigint"
    first = staging.clean(spark.createDataFrame(rows, ddl), ["id"], "at").orderBy("id").collect()
    again = staging.clean(spark.createDataFrame(rows[::-1], ddl), ["id"], "at").orderBy("id").collect()
    assert first == again and first[1].name == "x" and first[0].name in ("b", "c")


def test_strict_and_tolerant_casts(spark):
    raw = spark.createDataFrame([("p", "n/a")], "pair string, last string")
    for c in ("buy", "sell", "high", "low", "vol_coin", "vol_idr", "run_id"):
        raw = raw.withColumn(c, F.lit(None).cast("string"))
    raw = raw.withColumn("created_at", F.lit(None).cast("timestamp"))
    assert staging.stage("summaries", raw, strict=False).first().last_price is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        staging.stage("summaries", raw).collect()


def test_orderbook_and_ticker_documents(spark):
    docs = spark.createDataFrame([
        ("1", '{"pair":"btcidr","bids":[[9.5,1],[9,2]],"asks":[[10,3]],"timestamp":"2026-01-01T00:00:00Z"}',
         "2026-01-01T00:00:01Z")], "_id string, context string, ingested_at string")
    rows = [(r.side, r.level, r.price, r.quantity) for r in staging.stage_orderbooks(docs).collect()]
    assert sorted(rows) == [("ask", 1, 10.0, 3.0), ("bid", 1, 9.5, 1.0), ("bid", 2, 9.0, 2.0)]
    docs = docs.withColumn("context", F.lit('{"pair":"btcidr","last_price":5,"timestamp":"2026-01-01T00:00:00Z"}'))
    r = staging.stage_ticker_events(docs).first()
    assert (r.pair_id, r.last_price, r.buy_price) == ("btcidr", 5.0, None)
