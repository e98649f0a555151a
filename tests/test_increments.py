"""Incremental marts against the marts made in one go."""

import random
from datetime import date, datetime, timedelta
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from marketloom.jobs import increments, quotes, trading
from marketloom.operators import partials
from marketloom.operators.dateindex import DateIndex
from marketloom.operators.partials import PartialStore
from marketloom.plans import daily, marts
from marketloom.sinks.tables import mart_path

TICK = ("pair_id string, captured_at timestamp, last_price decimal(28,8), high_price decimal(28,8), "
        "low_price decimal(28,8), volume_idr decimal(28,8), volume_asset decimal(28,8), n long")
ORDER = "order_id long, user_id string, pair string, order_type string, quantity decimal(18,8), status string, updated_at timestamp"
TRADE = "trade_id long, order_id long, quantity decimal(18,8), executed_at timestamp"
EVENT = "event_id long, event_type string, user_id string, ingested_at timestamp"
DAY = datetime(2026, 1, 1)


def rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def ticks(spark, n, seed=1, days=6):
    rng = random.Random(seed)
    at = lambda: DAY + timedelta(days=rng.randrange(days), hours=rng.randrange(3))
    return [(rng.choice(["btc", "eth", None]), at() if rng.random() > 0.02 else None,
             *[D(rng.randrange(1, 99))] * 3, D(1), D(2), i) for i in range(n)]


def test_open_and_close_need_no_sort(spark, tmp_path):
    spark.createDataFrame(ticks(spark, 200), TICK).write.parquet(str(tmp_path / "t"))
    out = daily.daily_market(spark.read.parquet(str(tmp_path / "t")), "n")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "Sort [" not in plan and plan.count("Exchange") == 1


def test_whole_number_ties_order_as_pairs_do(spark):
    edge = [(t, n) for t in (None, datetime(1969, 12, 31, 23), DAY, datetime(9999, 12, 31)) for n in (
        None, -(2**63), -1, 0, 1, 2**63 - 1)]
    df = spark.createDataFrame(edge, "t timestamp, n long")
    from marketloom.functions import order_key

    packed = [tuple(r) for r in df.orderBy(order_key("t", "n", whole=True)).collect()]
    assert packed == [tuple(r) for r in df.orderBy(order_key("t", "n")).collect()]


@pytest.mark.parametrize("keep_old", [False, True])
def test_states_merge_repeat_and_compact(spark, tmp_path, monkeypatch, keep_old):
    """Also when a compaction dies before it removes what it has merged."""
    if keep_old:
        monkeypatch.setattr(partials, "delete", lambda *a: None)
    data = ticks(spark, 300)
    store = PartialStore(spark, str(tmp_path / "s"), quotes.market_model("n"), compact_after=2)
    parts = [data[k::6] for k in range(6)]
    for batch, part in enumerate(parts):
        dates = store.add(spark.createDataFrame(part, TICK), batch)
        store.add(spark.createDataFrame(part, TICK), batch)
    assert len(dates) == 7  # six days and the rows without one
    assert rows(store.current(dates)) == rows(daily.daily_market(spark.createDataFrame(data, TICK), "n"))
    with pytest.raises(ValueError, match="already part of a merged state"):
        store.add(spark.createDataFrame(parts[0], TICK), 0)
    if not keep_old:
        assert len(list((tmp_path / "s" / "date=2026-01-02" / "upto=-1").iterdir())) <= 3
    fresh = PartialStore(spark, str(tmp_path / "s"), quotes.market_model("n"))
    assert rows(fresh.current(dates)) == rows(store.current(dates))
    assert fresh.current([date(2030, 1, 1)]) is None


def test_dates_before_and_after(spark, tmp_path):
    index = DateIndex(spark, str(tmp_path / "i"))
    keys = lambda *k: spark.createDataFrame([(date(*d), s) for d, s in k], "date date, symbol string")
    index.add(keys(((2025, 12, 30), "a"), ((2026, 1, 5), "a"), ((2026, 1, 1), None)))
    index.add(keys(((2026, 1, 2), "a"), ((2026, 1, 5), "a")))
    got = index.neighbours(keys(((2026, 1, 2), "a"), ((2026, 1, 9), "a"), ((2026, 1, 1), None), ((2026, 1, 1), "new")))
    assert {(r.date.day, r.symbol): (r.previous, r.next) for r in got.collect()} == {
        (2, "a"): (date(2025, 12, 30), date(2026, 1, 5)), (9, "a"): (date(2026, 1, 5), None),
        (1, None): (None, None), (1, "new"): (None, None)}


def test_late_day_reads_its_neighbours_only(spark, tmp_path, monkeypatch):
    """A year of history; a late day in it touches three partitions of the model."""
    year = [("btc", DAY + timedelta(days=d), *[D(d + 1)] * 3, D(1), D(1), d) for d in range(365) if d != 200]
    late = [("btc", DAY + timedelta(days=200), *[D(7)] * 3, D(1), D(1), 200)]
    root, read = str(tmp_path), []
    quotes.load_quotes(spark, root, spark.createDataFrame(year, TICK), 0, "n")
    real = quotes.read_partitions
    monkeypatch.setattr(quotes, "read_partitions", lambda *a: read.append(real(*a)) or read[-1])
    touched = quotes.load_quotes(spark, root, spark.createDataFrame(late, TICK), 1, "n")
    assert sorted(touched) == [date(2026, 7, 20), date(2026, 7, 21)]
    assert [len(df.inputFiles()) for df in read] == [3]
    whole = daily.daily_market(spark.createDataFrame(year + late, TICK), "n")
    assert rows(spark.read.parquet(mart_path(root, "market_daily"))) == rows(marts.market_daily(whole))


def facts(seed=3, n=80):
    rng = random.Random(seed)
    at = lambda: DAY + timedelta(days=rng.randrange(5))
    orders = [(i if rng.random() > 0.05 else None, "u", rng.choice(["btc", "eth"]), rng.choice(["buy", "sell"]),
               D(rng.randrange(1, 9)), rng.choice(["filled", "open"]), at()) for i in range(n)]
    orders += [(5, "u", "eth", "buy", D(2), "open", DAY + timedelta(days=9)), (6, "u", "btc", "buy", D(1), "open", None)]
    trades = [(i, rng.choice([*range(n), 999, None]), D(rng.randrange(1, 5)), at()) for i in range(3 * n)]
    return orders, trades


def test_trades_reach_the_days_of_their_orders(spark, tmp_path):
    """Trades before and after their orders, orphans, repeated and missing ids, a slice twice."""
    orders, trades = facts()
    root = str(tmp_path)
    for batch in (0, 1, 2, 2):
        trading.load_trading(spark, root, batch, spark.createDataFrame(orders[batch::3], ORDER),
                             spark.createDataFrame(trades[::-1][batch::3], TRADE))
    want = daily.daily_trading(spark.createDataFrame(orders, ORDER), spark.createDataFrame(trades, TRADE))
    wide = lambda df: df.withColumns({c: F.col(c).cast("decimal(38,8)") for c in (
        "buy_volume", "sell_volume", "trading_volume")}).withColumn("avg_trade_size", F.round("avg_trade_size", 9))
    assert rows(wide(spark.read.parquet(mart_path(root, "trading_daily")))) == rows(wide(want))
    # A slice of trades alone touches the days of their orders and no other.
    day = orders[10][-1].date()
    assert trading.load_trading(spark, root, 3, trades=spark.createDataFrame([(900, 10, D(1), DAY)], TRADE)) == [day]
    assert trading.load_trading(spark, root, 4, trades=spark.createDataFrame([(901, 12345, D(1), DAY)], TRADE)) == []


def test_slices_of_all_sources_equal_one_load(spark, tmp_path):
    orders, trades = facts()
    quoted, rng = ticks(spark, 120, days=5), random.Random(8)
    events = [(i, rng.choice(["market_view", "login", "order_created"]), rng.choice(["u", "v", None]),
               DAY + timedelta(days=rng.randrange(6))) for i in range(90)]

    def staged(part):
        return {"summaries": spark.createDataFrame(quoted[part], TICK), "orders": spark.createDataFrame(orders[part], ORDER),
                "trades": spark.createDataFrame(trades[part], TRADE), "user_events": spark.createDataFrame(events[part], EVENT)}

    one, many = str(tmp_path / "one"), str(tmp_path / "many")
    increments.load_slice(spark, one, staged(slice(None)), 0, tie_break="n")
    for batch in (0, 1, 1):
        touched = increments.load_slice(spark, many, staged(slice(batch, None, 2)), batch, tie_break="n")
    assert set(touched) == set(marts.GRAIN) and touched["business_metrics"]
    for mart in marts.GRAIN:
        assert rows(spark.read.parquet(mart_path(one, mart))) == rows(spark.read.parquet(mart_path(many, mart))), mart
    # A later slice of one source alone reaches the business mart through the dates it changed.
    only = {"user_events": spark.createDataFrame([(500, "market_view", "new", DAY)], EVENT)}
    assert increments.load_slice(spark, many, only, 2)["business_metrics"] == [DAY.date()]
