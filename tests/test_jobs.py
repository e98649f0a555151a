"""Whole runs: daily marts, snapshot to star, streams, generators."""

import json
import os
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from marketloom import schemas
from marketloom.datagen import Generator, Sizes
from marketloom.jobs.daily import mart_path, run_daily, stage_all
from marketloom.jobs.snapshot import run_snapshot
from marketloom.plans import daily, staging
from marketloom.quality import rules, suites
from marketloom.sinks.tables import TableStore
from marketloom.sources import documents, landing
from marketloom.streaming.incremental import read_landing, stream_daily_market, stream_to_bronze

UTC = timezone.utc
NOW = datetime(2026, 9, 12, tzinfo=UTC)


@pytest.fixture(scope="module")
def gen(spark):
    return Generator(spark, NOW)


def summaries(gen):
    """Tabular summaries out of the generated ticker documents."""
    c = F.from_json("context", schemas.TICKER_CONTEXT)
    return gen.tickers().select(c.alias("c"), "ingested_at").select(
        F.col("c.pair").alias("pair"),
        *[F.col(f"c.{a}").cast("decimal(28,8)").cast("string").alias(b) for a, b in
          (("last_price", "last"), ("buy_price", "buy"), ("sell_price", "sell"), ("high_24h", "high"),
           ("low_24h", "low"), ("volume_idr", "vol_coin"), ("volume_idr", "vol_idr"))],
        F.col("ingested_at").cast("timestamp").alias("created_at"), F.lit("r").alias("run_id"))


def bronze(gen):
    return {**gen.relational(), "user_events": documents.tabular(gen.user_events()), "summaries": summaries(gen)}


# --- generator ---------------------------------------------------------------
def test_generated_tables(spark, gen):
    data = gen.relational()
    assert {n: df.count() for n, df in data.items()} == {
        "users": 64, "accounts": 96, "assets": 17, "orders": 640, "trades": 1280, "transactions": 320}
    for name, ddl in schemas.RELATIONAL.items():
        assert [(f.name, f.dataType) for f in data[name].schema] == [(f.name, f.dataType) for f in schemas.struct(ddl)]
    orders, trades = data["orders"], data["trades"]
    assert rules.relationship(trades, "order_id", orders, "order_id").isEmpty()
    assert rules.relationship(orders, "user_id", data["users"], "user_id").isEmpty()
    assert rules.relationship(data["accounts"], "user_id", data["users"], "user_id").isEmpty()
    assert rules.relationship(data["transactions"], "account_id", data["accounts"], "account_id").isEmpty()
    traded = orders.join(trades.select("order_id").distinct(), "order_id", "left_semi")
    assert {r.status for r in traded.select("status").distinct().collect()} == {"filled", "partially_filled"}
    shares = {r.status: r["count"] for r in orders.groupBy("status").count().collect()}
    assert shares == {"filled": 288, "partially_filled": 128, "open": 160, "cancelled": 64}


def test_generation_is_independent_of_partitioning(spark):
    one = Generator(spark, NOW, Sizes(orders=300))
    a = one.orders().agg(F.sum(F.xxhash64("*").cast("decimal(38,0)"))).first()[0]
    other = Generator(spark, NOW, Sizes(orders=300))
    other._rows = lambda n: (spark.range(0, n, 1, 7), F.col("id"))
    assert a == other.orders().agg(F.sum(F.xxhash64("*").cast("decimal(38,0)"))).first()[0]
    assert a != Generator(spark, NOW, Sizes(orders=300), seed=1).orders().agg(
        F.sum(F.xxhash64("*").cast("decimal(38,0)"))).first()[0]
    assert Sizes().scaled(100).orders == 64_000


def test_generated_documents(spark, gen):
    docs = gen.documents()
    for name, df in docs.items():
        assert documents.document_warnings(df, name).isEmpty()
    book = json.loads(docs["orderbooks"].first().context)
    assert len(book["bids"]) == len(book["asks"]) == 10 and book["bids"][0][0] < book["asks"][0][0]
    for r in docs["user_events"].collect():
        keys = set(json.loads(r.context)) - {"user_id", "session_id", "timestamp"}
        assert keys == {"order_created": {"pair", "price", "quantity"}, "order_updated": {"pair", "price", "quantity"},
                        "market_view": {"pair"}, "page_view": {"page"}}.get(r.event, set())
    events = staging.stage_user_events(docs["user_events"])
    assert rules.relationship(events, "user_id", gen.users(), "user_id").isEmpty()
    assert gen.first_marks().count() == 9


# --- daily run ----------------------------------------------------------------
def test_daily_run_twice_equals_once(spark, gen, tmp_path):
    data = bronze(gen)
    run_daily(spark, data, str(tmp_path), NOW)
    read = lambda m: sorted(map(str, spark.read.parquet(mart_path(str(tmp_path), m)).collect()))
    names = ("market_daily", "trading_daily", "user_activity_daily", "business_metrics")
    first = {m: read(m) for m in names}
    assert all(first.values())
    run_daily(spark, data, str(tmp_path), NOW)
    assert first == {m: read(m) for m in names}
    market = spark.read.parquet(mart_path(str(tmp_path), "market_daily"))
    assert market.where("low_price > open_price or high_price < close_price").isEmpty()


def test_injected_faults_are_counted(spark, gen):
    staged = stage_all(bronze(gen), NOW)
    model_rules = suites.model_rules()
    clean = rules.run_rules({m: staged[m] for m in staged}, model_rules)
    assert clean.where("violations > 0").isEmpty()
    orders = staged["orders"].withColumn("price", F.when(F.col("status") == "open", F.lit(0)).otherwise(F.col("price")))
    orders = orders.unionByName(orders.limit(3))
    got = {r.rule: r.violations for r in rules.long_summary("orders", orders, model_rules["orders"]).collect()}
    assert got["price_positive"] >= 100 and got["unique_order_id"] == 3 and got["not_null_pair"] == 0
    with pytest.raises(rules.DataQualityError, match="orders.unique_order_id: 3"):
        rules.require(rules.run_rules({"orders": orders}, model_rules))


def test_two_unique_rules_and_null_keys(spark):
    df = spark.createDataFrame([("a", "X"), ("b", "X"), (None, None), (None, "Y")], "asset_id string, symbol string")
    got = {r.rule: r.violations for r in rules.long_summary("assets", df, suites.model_rules()["assets"]).collect()}
    assert got == {"not_null_asset_id": 2, "unique_asset_id": 0, "not_null_symbol": 1, "unique_symbol": 1}


# --- snapshot run ----------------------------------------------------------------
def payload(root, stamp, prices):
    day, hour = f"{stamp[:4]}-{stamp[4:6]}-{stamp[6:8]}", stamp[9:11]
    tickers = {f"{p}_t": {"name": p, "buy": v, "sell": v, "high": v, "low": v, "last": v, "vol_idr": v, f"vol_{p}": 1}
               for p, v in prices.items()}
    files = {"pairs": [{"id": p, "ticker_id": f"{p}_t", "base_currency": "idr"} for p in prices],
             "summaries": {"tickers": tickers, "prices_24h": {p: 1 for p in prices}, "prices_7d": {}}}
    for name, value in files.items():
        folder = f"{root}/source=exchange/dataset={name}/ingestion_date={day}/hour={hour}"
        os.makedirs(folder)
        with open(f"{folder}/{name}_{stamp}.json", "w") as f:
            json.dump(value, f)


def test_snapshot_run_over_all_runs(spark, tmp_path):
    raw = str(tmp_path / "raw")
    payload(raw, "20260101T010203Z", {"btc": 5, "eth": 7})
    payload(raw, "20260102T010203Z", {"btc": 6})
    frames = [landing.read_payload(spark, d, landing.dataset_root(raw, "exchange", d)) for d in ("pairs", "summaries")]
    store = TableStore(spark, str(tmp_path / "star"))
    for expected in ((2, 2, 3), (0, 0, 0)):
        done = run_snapshot(spark, *frames, str(tmp_path / "lake"), store, audit_path=str(tmp_path / "audit"))
        assert (done.star.markets, done.star.dates, done.star.facts) == expected
    assert [r.rows_extracted for r in spark.read.parquet(str(tmp_path / "audit")).collect()] == [6, 6]
    gold = landing.read_snapshots(spark, f"{tmp_path}/lake/gold", "market_metrics", schemas.MARKET_METRICS)
    assert sorted((r.run_id, r.pair_id, r.volume_rank) for r in gold.collect()) == [
        ("20260101T010203Z", "btc", 2), ("20260101T010203Z", "eth", 1), ("20260102T010203Z", "btc", 1)]


def test_snapshot_run_publishes_nothing_broken(spark, tmp_path):
    raw = str(tmp_path / "raw")
    payload(raw, "20260101T010203Z", {"btc": -5})
    frames = [landing.read_payload(spark, d, landing.dataset_root(raw, "exchange", d)) for d in ("pairs", "summaries")]
    with pytest.raises(suites.SilverQualityError, match="last_price <= 0"):
        run_snapshot(spark, *frames, str(tmp_path / "lake"), TableStore(spark, str(tmp_path / "star")))
    assert not os.path.exists(tmp_path / "lake") and not os.path.exists(tmp_path / "star")


# --- streaming ---------------------------------------------------------------------
TICKS = ("pair_id string, captured_at timestamp, last_price double, high_price double, low_price double, "
         "volume_idr double, volume_asset double")


def land(spark, root, name, *rows):
    data = [(p, datetime.fromisoformat(at), v, v, v, 1.0, 1.0) for p, at, v in rows]
    spark.createDataFrame(data, TICKS).coalesce(1).write.json(f"{root}/{name}")


def test_stream_equals_batch_with_late_rows_and_failure(spark, tmp_path):
    landed, root = str(tmp_path / "in"), str(tmp_path / "out")
    fail = {"on": False}

    def stage(df):
        if fail["on"]:
            raise RuntimeError("stopped")
        return df

    def go():
        stream = read_landing(spark, f"{landed}/*", schemas.struct(TICKS), max_files=1)
        return stream_daily_market(spark, stream, root, stage)

    def rows(df):
        return sorted(map(str, df.select("date", "symbol", "open_price", "close_price", "volume_idr").collect()))

    def batch():
        return rows(daily.daily_market(spark.read.schema(TICKS).json(f"{landed}/*")))

    land(spark, landed, "a", ("btc", "2026-01-01T09:00", 1.0), ("btc", "2026-01-02T09:00", 2.0))
    land(spark, landed, "b", ("eth", "2026-01-01T09:00", 5.0))
    assert rows(go()) == batch()
    # Nothing new: nothing changes.
    assert rows(go()) == batch()
    # A late tick opens an old day anew; the first attempt dies, the next one completes it.
    land(spark, landed, "c", ("btc", "2026-01-01T08:00", 9.0))
    fail["on"] = True
    with pytest.raises(Exception, match="stopped"):
        go()
    fail["on"] = False
    out = rows(go())
    assert out == batch() and any("open_price=9.0" in r for r in out)


def test_stream_to_bronze_lands_rows_once(spark, gen, tmp_path):
    landed, out, mark = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "mark")

    def go():
        stream = read_landing(spark, f"{landed}/*", schemas.struct(schemas.DOCUMENT))
        return stream_to_bronze(stream, out, "mongodb", "user_events", mark)

    docs = gen.user_events()
    docs.where("event = 'login'").write.json(f"{landed}/a")
    go()
    go()
    docs.where("event <> 'login'").write.json(f"{landed}/b")
    path = go()
    back = spark.read.schema(schemas.DOCUMENT).json(path)
    assert sorted(map(str, back.select("_id", "ingested_at").collect())) == sorted(
        map(str, docs.select("_id", "ingested_at").collect()))
    # A batch delivered again replaces itself.
    assert back.select("_id").distinct().count() == back.count() == 640
