"""Staging models: typed, renamed projections of the Bronze tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom import schemas
from marketloom.functions import as_timestamp, as_variant, cast_to, json_string
from marketloom.operators.dedup import keep_first

# Output column, source column, type. Timestamps are UTC instants.
_MODELS: dict[str, list[tuple[str, str, str]]] = {
    "pairs": [
        ("pair_id", "pair", "string"),
        ("ticker_id", "ticker_id", "string"),
        ("asset_name", "name", "string"),
        ("base_currency", "base_currency", "string"),
        ("quote_currency", "quote_currency", "string"),
        ("price_decimal_places", "price_decimal_places", "int"),
        ("min_price", "min_price", "decimal(18,8)"),
        ("max_price", "max_price", "decimal(18,8)"),
        ("min_volume", "min_volume", "decimal(18,8)"),
        ("created_at", "created_at", "timestamp"),
        ("run_id", "run_id", "string"),
    ],
    "summaries": [
        ("pair_id", "pair", "string"),
        ("last_price", "last", "decimal(28,8)"),
        ("buy_price", "buy", "decimal(28,8)"),
        ("sell_price", "sell", "decimal(28,8)"),
        ("high_price", "high", "decimal(28,8)"),
        ("low_price", "low", "decimal(28,8)"),
        ("volume_asset", "vol_coin", "decimal(28,8)"),
        ("volume_idr", "vol_idr", "decimal(28,8)"),
        ("captured_at", "created_at", "timestamp"),
        ("run_id", "run_id", "string"),
    ],
}
# Suffix of the ticker id the tabular summaries are given.
TICKER_SUFFIX = "_IDR"


def _columns(model: str) -> list[tuple[str, str, str]]:
    """The relational tables keep their column names; only the types are imposed."""
    if model in _MODELS:
        return _MODELS[model]
    return [(f.name, f.name, f.dataType.simpleString()) for f in schemas.struct(schemas.RELATIONAL[model])]


def _stamp(now: Column | None) -> Column:
    return F.current_timestamp() if now is None else now


def stage(model: str, df: DataFrame, now: Column | None = None, strict: bool = True) -> DataFrame:
    """Stage one tabular model.

    ``strict`` casts raise on bad text; otherwise bad text becomes NULL, for
    use with the quarantine split. ``now`` is the load time to stamp.
    """
    columns = [cast_to(source, to, strict).alias(out) for out, source, to in _columns(model)]
    if model == "summaries":
        columns.insert(1, F.concat(F.col("pair").cast("string"), F.lit(TICKER_SUFFIX)).alias("ticker_id"))
        return df.select(*columns, _stamp(now).alias("ingested_at"))
    return df.select(*columns, _stamp(now).alias("captured_at"))


def stage_user_events(df: DataFrame, now: Column | None = None) -> DataFrame:
    """Flatten the envelope; ``context`` stays available as a variant."""
    return df.select(
        F.col("_id").cast("string").alias("event_id"),
        F.col("event").cast("string").alias("event_type"),
        json_string("context", "user_id").alias("user_id"),
        json_string("context", "session_id").alias("session_id"),
        as_timestamp(json_string("context", "timestamp")).alias("event_timestamp"),
        as_variant("context").alias("event_properties"),
        as_timestamp("ingested_at").alias("ingested_at"),
        _stamp(now).alias("captured_at"),
    )


def stage_ticker_events(df: DataFrame, now: Column | None = None) -> DataFrame:
    """Flatten ticker documents into one row per quote."""
    context = F.from_json("context", schemas.TICKER_CONTEXT)
    return df.select(
        F.col("_id").alias("event_id"), context.alias("c"), F.col("ingested_at")
    ).select(
        "event_id",
        F.col("c.pair").alias("pair_id"),
        "c.ticker_id", "c.last_price", "c.buy_price", "c.sell_price",
        "c.high_24h", "c.low_24h", "c.volume_idr",
        as_timestamp("c.timestamp").alias("event_timestamp"),
        as_timestamp("ingested_at").alias("ingested_at"),
        _stamp(now).alias("captured_at"),
    )


def stage_orderbooks(df: DataFrame, now: Column | None = None) -> DataFrame:
    """One row per order book level: side, level (1 is the best), price, quantity."""
    book = F.from_json("context", schemas.ORDERBOOK_CONTEXT)
    sides = F.array(
        F.struct(F.lit("bid").alias("side"), F.col("c.bids").alias("levels")),
        F.struct(F.lit("ask").alias("side"), F.col("c.asks").alias("levels")),
    )
    return (
        df.select(F.col("_id").alias("event_id"), book.alias("c"), F.col("ingested_at"))
        .select("event_id", "c.pair", "ingested_at", F.explode(sides).alias("s"))
        .select("event_id", "pair", "ingested_at", "s.side", F.posexplode("s.levels"))
        .select(
            "event_id",
            F.col("pair").alias("pair_id"),
            "side",
            (F.col("pos") + 1).alias("level"),
            F.try_element_at("col", F.lit(1)).alias("price"),
            F.try_element_at("col", F.lit(2)).alias("quantity"),
            as_timestamp("ingested_at").alias("ingested_at"),
            _stamp(now).alias("captured_at"),
        )
    )


def clean(df: DataFrame, keys: Sequence[str], newest: str) -> DataFrame:
    """Trim text columns and keep the newest row per key.

    Rows equal in key and ``newest`` are told apart by their whole content,
    so the outcome does not depend on the order rows arrive in.
    """
    trimmed = df.select(
        *[F.trim(c).alias(c) if t == "string" else F.col(c) for c, t in df.dtypes]
    )
    content = F.xxhash64(*[c for c, t in df.dtypes if not t.startswith(("variant", "map"))])
    return keep_first(trimmed, keys, [F.col(newest).desc_nulls_last(), content])
