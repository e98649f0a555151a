from datetime import datetime, timezone

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from marketloom import schemas
from marketloom.context import RunContext
from marketloom.plans.snapshot import (
    build_market_metrics, build_market_snapshot, tabular_pairs, tabular_summaries, with_run,
)
from marketloom.plans.staging import stage
from marketloom.quality.suites import (
    GoldQualityError, SilverQualityError, validate_market_metrics, validate_market_snapshot,
)

CTX = RunContext.create(datetime(2026, 8, 26, 12, tzinfo=timezone.utc))
TICKER = {"buy": "100", "sell": "101", "high": "110", "low": "90", "last": "105", "name": "Bitcoin",
          "server_time": "1756200000", "vol_btc": "20.5", "vol_idr": "2000000000"}


def payloads(spark, tickers, day=None, week=None, pairs=(("btcidr", "btc_idr"),)):
    p = spark.createDataFrame([(i, t, "BTC", "idr", "btc", None) for i, t in pairs], schemas.PAIRS_PAYLOAD)
    s = spark.createDataFrame([(tickers, day, week)], schemas.SUMMARIES_PAYLOAD)
    return p, with_run(s, CTX, "x/summaries_20260826T120000Z.json")


def test_snapshot_mapping(spark):
    p, s = payloads(spark, {"btc_idr": TICKER}, {"btcidr": "95"}, {"btcidr": "80"})
    rows = build_market_snapshot(p, s).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.pair_id, r.ticker_id, r.asset_name) == ("btcidr", "btc_idr", "Bitcoin")
    assert (r.buy_price, r.last_price, r.price_24h_ago, r.price_7d_ago) == (100.0, 105.0, 95.0, 80.0)
    assert (r.volume_asset, r.volume_idr, r.run_id, r.ingestion_date) == (20.5, 2e9, CTX.run_id, "2026-08-26")
    assert build_market_snapshot(p, s).columns == schemas.columns(schemas.MARKET_SNAPSHOT)


def test_dynamic_volume_name(spark):
    t = {**TICKER, "vol_eth": "100.25", "vol_idr": "5000000000"}
    t.pop("vol_btc")
    p, s = payloads(spark, {"eth_idr": t}, pairs=[("ethidr", "eth_idr")])
    r = build_market_snapshot(p, s).first()
    assert (r.volume_asset, r.volume_idr) == (100.25, 5e9)


def test_pair_without_ticker_and_missing_prices(spark):
    p, s = payloads(spark, {"btc_idr": {**TICKER, "last": "n/a", "server_time": "later"}},
                    pairs=[("btcidr", "btc_idr"), ("ethidr", "eth_idr")])
    rows = build_market_snapshot(p, s).collect()
    assert [(r.pair_id, r.last_price, r.price_24h_ago, r.source_timestamp) for r in rows] == [
        ("btcidr", None, None, None)]


def test_many_tickers_meet_their_prices_in_one_pass(spark, tmp_path):
    """Unlisted tickers, tickers of two pairs, a pair of two tickers, missing maps, null tickers, two documents."""
    pairs = [("a", "a_t"), ("b", "ab_t"), ("a2", "ab_t"), ("a", "extra_t"), ("c", "gone_t")]
    full = {k: {**TICKER, "last": str(i)} for i, k in enumerate(("a_t", "ab_t", "extra_t", "unlisted_t"))}
    p, s = payloads(spark, {**full, "null_t": None}, {"a": "1", "b": "2", "zz": "9"}, {"a2": "3"}, pairs)
    empty = spark.createDataFrame([(None, {"a": "7"}, None)], schemas.SUMMARIES_PAYLOAD)
    other = spark.createDataFrame([({"a_t": {"last": "50"}}, None, None)], schemas.SUMMARIES_PAYLOAD)
    docs = s.unionByName(with_run(empty, CTX, "x/e.json")).unionByName(with_run(other, CTX, "x/o.json"))
    docs.write.parquet(str(tmp_path / "docs"))
    out = build_market_snapshot(p, spark.read.parquet(str(tmp_path / "docs")))
    got = [(r.source_file[2], r.pair_id, r.ticker_id, r.last_price, r.price_24h_ago, r.price_7d_ago) for r in out.collect()]
    assert sorted(got, key=str) == sorted([
        ("o", "a", "a_t", 50.0, None, None), ("s", "a", "a_t", 0.0, 1.0, None), ("s", "a", "extra_t", 2.0, 1.0, None),
        ("s", "b", "ab_t", 1.0, 2.0, None), ("s", "a2", "ab_t", 1.0, None, 3.0)], key=str)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 1 and plan.count("Generate") == 1


def metrics(spark, *rows):
    names = schemas.columns(schemas.MARKET_SNAPSHOT)
    full = [tuple({"pair_id": f"p{i}", "run_id": "r", "captured_at": CTX.captured_at, **r}.get(n) for n in names)
            for i, r in enumerate(rows)]
    return build_market_metrics(spark.createDataFrame(full, schemas.MARKET_SNAPSHOT))


def test_price_changes_and_spread(spark):
    r = metrics(spark, {"last_price": 110.0, "price_24h_ago": 100.0, "price_7d_ago": 80.0,
                        "buy_price": 100.0, "sell_price": 105.0}).first()
    assert (r.price_change_24h, r.price_change_24h_pct) == (10.0, pytest.approx(10.0))
    assert (r.price_change_7d, r.price_change_7d_pct) == (30.0, pytest.approx(37.5))
    assert (r.spread, r.spread_pct) == (5.0, pytest.approx(5.0))


@pytest.mark.parametrize("one_document", [True, False])
def test_volume_rank_is_dense_and_skips_missing(spark, one_document):
    names = schemas.columns(schemas.MARKET_SNAPSHOT)
    volumes = [("a", 3e6), ("a", 2e6), ("a", 3e6), ("a", None), ("a", float("nan")), ("b", 1.0), ("b", 7.0)]
    rows = [tuple({"pair_id": f"p{i}", "run_id": run, "volume_idr": v}.get(n) for n in names)
            for i, (run, v) in enumerate(volumes)]
    out = build_market_metrics(spark.createDataFrame(rows, schemas.MARKET_SNAPSHOT), one_document)
    got = {r.pair_id: r.volume_rank for r in out.collect()}
    assert got == {"p0": 1, "p1": 2, "p2": 1, "p3": None, "p4": None, "p5": 2, "p6": 1}


def test_tabular_forms(spark):
    p, s = payloads(spark, {"btc_idr": TICKER, "new_idr": {"last": "1"}})
    p = p.withColumn("source_file", F.lit("x/pairs_20260826T120000Z.json"))
    pair = tabular_pairs(p).first()
    assert (pair.pair, pair.base_currency, pair.quote_currency, pair.min_price, pair.run_id) == (
        "btcidr", "IDR", "BTC", None, "pairs_20260826T120000Z")
    rows = {r.pair: r for r in tabular_summaries(s, p).collect()}
    assert set(rows) == {"btcidr", "new_idr"}
    assert (rows["btcidr"].vol_coin, rows["btcidr"].run_id) == ("20.5", "summaries_20260826T120000Z")
    assert rows["new_idr"].created_at is None
    staged = {r.pair_id: r for r in stage("summaries", tabular_summaries(s, p)).collect()}
    assert staged["btcidr"].ticker_id == "btcidr_IDR" and float(staged["btcidr"].last_price) == 105.0


# --- checks -------------------------------------------------------------------
SILVER_ROW = dict(pair_id="btcidr", ticker_id="btc_idr", last_price=100.0, high_price=110.0, low_price=90.0,
                  volume_idr=1000.0, captured_at=CTX.captured_at, run_id="r")


def silver(spark, *changes):
    ddl = ("pair_id string, ticker_id string, last_price double, high_price double, low_price double, "
           "volume_idr double, captured_at timestamp, run_id string")
    rows = [{**SILVER_ROW, "pair_id": f"p{i}", **c} for i, c in enumerate(changes)]
    return spark.createDataFrame([Row(**r) for r in rows], ddl)


def test_silver_passes(spark):
    validate_market_snapshot(silver(spark, {}, {"high_price": None}, {"low_price": float("nan")}))


@pytest.mark.parametrize("changes,text", [
    ([{}, {"last_price": -100.0}], "Found 1 records with last_price <= 0"),
    ([{"pair_id": "x"}, {"pair_id": "x"}, {"pair_id": "x"}], "Found 2 duplicate pair_id"),
    ([{"high_price": 100.0, "low_price": 200.0}], "high_price < low_price"),
    ([{"volume_idr": -1.0}], "negative volume_idr"),
    ([{"last_price": float("nan")}, {"ticker_id": None}], "last_price contains 1 null values"),
])
def test_silver_fails(spark, changes, text):
    with pytest.raises(SilverQualityError, match=text.replace("(", r"\(")):
        validate_market_snapshot(silver(spark, *changes))


def test_silver_reports_all_failures_and_missing_columns(spark):
    with pytest.raises(SilverQualityError) as e:
        validate_market_snapshot(silver(spark, {"last_price": -1.0, "volume_idr": -1.0}))
    assert "last_price <= 0" in str(e.value) and "negative volume_idr" in str(e.value)
    with pytest.raises(SilverQualityError, match="Missing required columns: \\['run_id'\\]"):
        validate_market_snapshot(silver(spark, {}).drop("run_id"))


def gold(spark, **changes):
    base = {"last_price": 110.0, "price_24h_ago": 100.0, "price_7d_ago": 80.0, "buy_price": 100.0,
            "sell_price": 105.0, "volume_idr": 5.0}
    df = metrics(spark, base)
    return df.withColumns({k: F.lit(v).cast(df.schema[k].dataType) for k, v in changes.items()})


def test_gold_passes_also_with_null_rank(spark):
    validate_market_metrics(gold(spark))
    validate_market_metrics(gold(spark, volume_rank=None))


@pytest.mark.parametrize("changes,text", [
    ({"last_price": 0.0}, "last_price <= 0"), ({"volume_rank": -1}, "volume_rank < 1"),
    ({"spread": 999.0}, "inconsistent spread"), ({"price_change_24h": 999.0}, "inconsistent 24h"),
    ({"price_change_7d": 999.0}, "inconsistent 7d"),
])
def test_gold_fails(spark, changes, text):
    with pytest.raises(GoldQualityError, match=text):
        validate_market_metrics(gold(spark, **changes))


def test_gold_duplicates_and_missing(spark):
    with pytest.raises(GoldQualityError, match="duplicate"):
        validate_market_metrics(gold(spark).unionByName(gold(spark)))
    with pytest.raises(GoldQualityError, match="Missing required columns"):
        validate_market_metrics(gold(spark).drop("spread"))
