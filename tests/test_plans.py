"""Plan shapes and hot keys: what the models promise about scale."""

import pytest
from pyspark.sql import functions as F

from marketloom.plans import daily, marts, models
from marketloom.quality import rules, suites
from marketloom.registry import QUERIES
from marketloom.registry import inputs as src

SMALL_SKEW = {
    "spark.sql.shuffle.partitions": "16",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


@pytest.fixture
def skew(spark):
    """Make a few hundred kilobytes count as a skewed partition; no broadcasts."""
    old = {k: spark.conf.get(k, None) for k in SMALL_SKEW}
    for k, v in SMALL_SKEW.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    return execution.executedPlan().toString().split("== Initial Plan")[0]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def at():
    return F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") % 500_000)


def hot_trades(spark, n=60_000):
    """A third of all trades belong to order 7."""
    return spark.range(0, n, 1, 8).select(
        F.col("id").alias("trade_id"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 20_000).alias("order_id"),
        F.col("id").cast("decimal(18,8)").alias("price"),
        (F.col("id") % 10).cast("decimal(18,8)").alias("quantity"),
        F.md5(F.col("id").cast("string")).alias("taker_side"), at().alias("executed_at"))


def some_orders(spark, n=25_000, hot=False):
    order_id = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")) if hot else F.abs("id")
    return spark.range(0, n, 1, 8).select(
        order_id.alias("order_id"), (F.col("id") % 100).alias("user_id"),
        (F.col("id") % 5).cast("string").alias("pair"), F.lit("buy").alias("order_type"),
        F.lit(1).cast("decimal(18,8)").alias("price"), F.lit(2).cast("decimal(18,8)").alias("quantity"),
        F.lit(2).cast("decimal(18,8)").alias("filled_quantity"),
        F.md5(F.col("id").cast("string")).alias("status"), at().alias("created_at"), at().alias("updated_at"))


def some_events(spark):
    return spark.range(0, 30_000, 1, 8).select(
        F.col("id").alias("event_id"), F.lit("login").alias("event_type"),
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 500).alias("user_id"),
        at().alias("ingested_at"))


def test_order_with_a_third_of_all_trades_is_split(skew):
    orders, trades = some_orders(skew), hot_trades(skew)
    out = daily.orders_trades(orders, trades)
    p = final_plan(out)
    assert "skew=true" in p and "ReusedExchange" in p
    joined = orders.join(trades.select("order_id", "trade_id"), "order_id", "left")
    assert out.count() == joined.count()
    assert out.agg(F.sum("trade_id"), F.count_if(F.col("trade_id").isNull())).first() == joined.agg(
        F.sum("trade_id"), F.count_if(F.col("trade_id").isNull())).first()


def test_user_activity_splits_the_hot_order(skew):
    out = daily.user_trading_activity(some_orders(skew), hot_trades(skew), some_events(skew))
    assert "skew=true" in final_plan(out)
    totals = out.agg(F.sum("total_orders"), F.sum("total_trades"), F.sum("total_events")).first()
    traded = hot_trades(skew).where("order_id < 25000").count()
    assert tuple(totals) == (25_000, traded, 30_000)


def test_daily_trading_never_ships_the_fan_out(skew):
    orders, trades = some_orders(skew), hot_trades(skew)
    for unique, exchanges in ((True, 3), (False, 4)):
        out = daily.daily_trading(orders, trades, unique_orders=unique)
        p = final_plan(out)
        assert "Expand" not in p and p.count("Exchange hashpartitioning") == exchanges
        assert float(out.agg(F.sum("trading_volume")).first()[0]) == float(
            trades.agg(F.sum("quantity")).first()[0])


def test_daily_trading_reduces_a_repeated_order_id_before_the_join(skew):
    orders, trades = some_orders(skew, 60_000, hot=True), hot_trades(skew, 3_000)
    out = daily.daily_trading(orders, trades)
    p = final_plan(out)
    assert p.index("LeftOuter") < p.index("partial_max(_filled")
    assert out.agg(F.sum("total_orders")).first()[0] == orders.select(
        F.to_date("updated_at"), "pair", "order_id").distinct().count()


def test_hot_symbol_is_reduced_before_the_exchange(spark, sf_dir):
    p = plan(daily.daily_market(src.ticks(spark, sf_dir)))
    assert p.count("Exchange") == 1 and "partial_min_by" in p and "Window" not in p
    assert "SortAggregate" not in p
    assert "props" not in p.split("ReadSchema")[-1]


def test_mart_adds_one_window_on_daily_rows(spark, sf_dir):
    p = plan(marts.market_daily(daily.daily_market(src.ticks(spark, sf_dir))))
    assert p.count("Window [") == 1 and p.count("Exchange") == 2


def test_incremental_filter_reaches_the_scan(spark, sf_dir):
    p = plan(QUERIES["incremental_slice"](spark, sf_dir))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThan(o_orderdate" in p
    assert "o_orderpriority" not in p


WRITING = {"upsert_market", "bronze_roundtrip", "lake_roundtrip", "star_load", "streaming_daily_market",
           "streaming_user_activity"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITING))
def test_no_products_no_python(spark, sf_dir, name):
    p = plan(QUERIES[name](spark, sf_dir))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "BatchEvalPython",
                 "MapInPandas", "collect_list", "collect_set"):
        assert node not in p


def test_rules_send_keys_only(spark, sf_dir):
    """One scan and one exchange of keys; what breaks row rules is settled before it."""
    shape = plan(rules.long_summary("trades", src.trades(spark, sf_dir), suites.model_rules()["trades"]))
    assert shape.count("FileScan") == 1
    keys = [line for line in shape.splitlines() if "Exchange hashpartitioning" in line]
    assert len(keys) == 1 and keys[0].count("_key_") == 1 and "price" not in keys[0]
    assert shape.count("HashAggregate") == 4 and "SortAggregate" not in shape


def test_models_are_built_in_order_and_shared_ones_stored_once(spark):
    stored, one = [], spark.range(3)

    def store(df, label):
        stored.append(label)
        return df

    a, b = models.Model("a", "x", ("bronze.s",), lambda s: s), models.Model("b", "y", ("x.a",), lambda s: s)
    both = models.Model("both", "y", ("y.b", "x.a"), lambda s, t: s.union(t))
    absent = models.Model("absent", "y", ("bronze.t", "x.a"), lambda s, t: s)
    built = models.build([both, absent, b, a], {"bronze.s": one}, store)
    assert set(built) == {"x.a", "y.b", "y.both"} and stored == ["x-a"] and built["y.both"].count() == 6
    with pytest.raises(KeyError, match="bronze.other"):
        models.build([a], {"bronze.other": one}, store)
    with pytest.raises(ValueError):  # a circle
        models.build([models.Model("c", "x", ("x.c",), lambda s: s)], {}, store)
