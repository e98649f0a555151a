from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from marketloom import functions as fx


def one(spark, column, value, ddl="c string"):
    return spark.createDataFrame([(value,)], ddl).select(column.alias("x")).first().x


@pytest.mark.parametrize("text,expected", [
    ("1.5", 1.5), (" 2 ", 2.0), ("1e3", 1000.0), ("abc", None), ("", None), (None, None),
    ("NaN", None), ("1.5d", None), ("2f", None), ("0x1p3", None), ("-0.25", -0.25),
])
def test_to_double(spark, text, expected):
    assert one(spark, fx.to_double("c"), text) == expected


def test_to_double_keeps_infinity(spark):
    assert one(spark, fx.to_double("c"), "inf") == float("inf")


@pytest.mark.parametrize("text,expected", [
    ("1700000000", 1700000000), ("1.5", None), ("x", None), (None, None), ("99999999999999", None),
])
def test_epoch_to_timestamp(spark, text, expected):
    assert one(spark, F.unix_seconds(fx.epoch_to_timestamp("c")), text) == expected


def test_epoch_strict(spark):
    seconds = F.unix_seconds(fx.epoch_to_timestamp_strict("c"))
    assert one(spark, seconds, "0") is None
    assert one(spark, seconds, "") is None
    assert one(spark, seconds, "60") == 60
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, seconds, "soon")


def test_dynamic_volume(spark):
    ddl = "c map<string,string>"
    assert one(spark, fx.dynamic_volume("c"), {"vol_idr": "5", "vol_eth": "100.25"}, ddl) == "100.25"
    assert one(spark, fx.dynamic_volume("c"), {"vol_idr": "5"}, ddl) is None


def test_guarded_pct_and_prior_price(spark):
    df = spark.createDataFrame([(110.0, 100.0), (1.0, 0.0), (1.0, -5.0), (None, 3.0)], "a double, b double")
    got = [r.x for r in df.select(fx.pct_change("a", "b").alias("x")).collect()]
    assert got == [pytest.approx(10.0), None, None, None]
    assert one(spark, fx.prior_price(F.lit(110.0), F.lit(10.0)), "") == pytest.approx(100.0)
    assert one(spark, fx.prior_price(F.lit(110.0), F.lit(-100.0)), "") is None


def test_nan_percentage_base_is_no_base(spark):
    assert one(spark, fx.guarded_pct(F.lit(1.0), F.lit(float("nan"))), "") is None


@pytest.mark.parametrize("a,b,expected", [
    (1.0, 1.0 + 1e-9, True), (1.0, 1.1, False), (None, None, True), (None, 1.0, False), (1.0, None, False),
])
def test_is_close(spark, a, b, expected):
    df = spark.createDataFrame([(a, b)], "a double, b double")
    assert df.select(fx.is_close("a", "b").alias("x")).first().x is expected


def test_run_names(spark):
    for path in ("s3a://b/hour=14/orders_20260912T140000Z.json", "/x/orders_20260912T140000Z.json/part-0.json"):
        assert one(spark, fx.file_stem("c"), path) == "orders_20260912T140000Z"
        assert one(spark, F.unix_seconds(fx.file_captured_at("c")), path) == int(
            datetime(2026, 9, 12, 14, tzinfo=timezone.utc).timestamp())


def test_isoformat(spark):
    at = datetime(2026, 9, 12, 14, 0, 5, tzinfo=timezone.utc)
    assert one(spark, fx.isoformat("c"), at, "c timestamp") == "2026-09-12T14:00:05+00:00"
    assert one(spark, fx.isoformat("c"), at.replace(microsecond=7), "c timestamp") == "2026-09-12T14:00:05.000007+00:00"
    assert one(spark, fx.iso_text("c"), at, "c timestamp") == "2026-09-12T14:00:05Z"


def test_map_or_empty_and_profile(spark):
    assert one(spark, fx.map_or_empty("c"), None, "c map<string,string>") == {}
    profile = one(spark, fx.section_profile("c"), {"a": "1"}, "c map<string,string>")
    assert (profile.entries, profile.sample_key, profile.sample_value) == (1, "a", "1")


def test_order_key_breaks_ties(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (0, "z")], "s bigint, run string")
    key = fx.order_key(F.timestamp_seconds("s"), "run")
    assert df.agg(F.max_by("run", key).alias("x"), F.min_by("run", key).alias("y")).first() == ("b", "z")
