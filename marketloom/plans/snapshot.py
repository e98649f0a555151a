"""Snapshot path: API payloads to the market snapshot and its metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom import schemas
from marketloom.context import RunContext
from marketloom.functions import (
    dynamic_volume, epoch_to_timestamp, epoch_to_timestamp_strict, file_captured_at, file_stem,
    guarded_pct, ingestion_date, map_or_empty, nan_to_null, to_double,
)
from marketloom.operators.ranking import dense_rank_desc, dense_rank_in_run


def with_run(df: DataFrame, ctx: RunContext, source_file: str | Column) -> DataFrame:
    """Attach one run's id, time and file to payload rows."""
    return df.withColumns({
        "run_id": F.lit(ctx.run_id),
        "captured_at": ctx.captured_at_col,
        "source_file": F.lit(source_file) if isinstance(source_file, str) else source_file,
    })


def build_market_snapshot(pairs: DataFrame, summaries: DataFrame) -> DataFrame:
    """One row per listed pair that has a ticker, per run.

    ``pairs``: ``id, ticker_id`` and, if pair lists differ by run, ``run_id``.
    ``summaries``: documents, told apart by (run, source_file, captured_at), with the maps ``tickers``,
    ``prices_24h``, ``prices_7d`` plus ``run_id, captured_at, source_file``.

    A document is read once. Its tickers and prior prices are exploded together,
    as rows that hold just the fields in use, and resolved to listed pairs in one
    join: tickers by ticker id, prices by pair id. Rows of one document and pair
    then meet in one window, so neither a ticker's other fields nor a document's
    maps are shuffled, and no document is joined with itself.
    """
    run = ["run_id"] if "run_id" in pairs.columns else []
    document = ["run_id", "captured_at", "source_file"]
    looked_up = ("buy", "sell", "high", "low", "last", "vol_idr", "server_time")

    def ticker(e: Column) -> Column:
        t = e["value"]
        return F.struct(
            F.lit("ticker").alias("kind"), e["key"].alias("key"),
            F.when(t.isNotNull(), F.struct(
                e["key"].alias("ticker_id"), F.try_element_at(t, F.lit("name")).alias("asset_name"),
                *[F.try_element_at(t, F.lit(f)).alias(f) for f in looked_up],
                dynamic_volume(t).alias("vol_asset"))).alias("quote"),
            F.lit(None).cast("struct<day: string, week: string>").alias("prior"))

    def price(e: Column) -> Column:
        quote = ", ".join(f"{f}: string" for f in ("ticker_id", "asset_name", *looked_up, "vol_asset"))
        return F.struct(F.lit("price").alias("kind"), e["key"].alias("key"),
                        F.lit(None).cast(f"struct<{quote}>").alias("quote"), e["value"].alias("prior"))

    prices = F.map_zip_with(map_or_empty("prices_24h"), map_or_empty("prices_7d"),
                            lambda _, day, week: F.struct(day.alias("day"), week.alias("week")))
    tickers = F.transform(F.map_entries(F.col("tickers")), ticker)
    rows = summaries.where("tickers IS NOT NULL").select(
        *document, F.explode(F.concat(tickers, F.transform(F.map_entries(prices), price))).alias("_row")
    ).select(*document, "_row.*").where("quote IS NOT NULL OR kind = 'price'")
    listed = pairs.select(F.lit("ticker").alias("kind"), F.col("ticker_id").alias("key"), F.col("id").alias("pair_id"), *run)
    priced = pairs.select(F.lit("price").alias("kind"), F.col("id").alias("key"), F.col("id").alias("pair_id"), *run).distinct()
    # Bounded: the tickers of one pair in one document, and its prior prices.
    of_pair = Window.partitionBy(*document, "pair_id")
    texts = (
        rows.join(listed.unionByName(priced), ["kind", "key", *run])
        .withColumn("prior", F.max("prior").over(of_pair)).where("kind = 'ticker'")
        .select(*document, "pair_id", "quote.*", "prior.day", "prior.week")
    )
    return texts.select(
        "pair_id", "ticker_id", "asset_name",
        to_double("buy").alias("buy_price"),
        to_double("sell").alias("sell_price"),
        to_double("high").alias("high_price"),
        to_double("low").alias("low_price"),
        to_double("last").alias("last_price"),
        to_double("day").alias("price_24h_ago"),
        to_double("week").alias("price_7d_ago"),
        to_double("vol_asset").alias("volume_asset"),
        to_double("vol_idr").alias("volume_idr"),
        epoch_to_timestamp("server_time").alias("source_timestamp"),
        "captured_at",
        ingestion_date("captured_at").alias("ingestion_date"),
        "source_file",
        "run_id",
    )


def build_market_metrics(silver: DataFrame, one_document_per_run: bool = True) -> DataFrame:
    """Price changes, spread and volume rank on top of a snapshot.

    A run's rows come from one API document, so ranking them is one window
    group per run. With ``one_document_per_run=False`` a run may be of any
    size and the rank is taken over a distributed sort instead.
    """
    numbers = [f.name for f in silver.schema if f.dataType.simpleString() == "double"]
    df = silver.withColumns({c: nan_to_null(c) for c in numbers})
    df = df.withColumns({
        "price_change_24h": F.col("last_price") - F.col("price_24h_ago"),
        "price_change_7d": F.col("last_price") - F.col("price_7d_ago"),
        "spread": F.col("sell_price") - F.col("buy_price"),
    })
    df = df.withColumns({
        "price_change_24h_pct": guarded_pct("price_change_24h", "price_24h_ago"),
        "price_change_7d_pct": guarded_pct("price_change_7d", "price_7d_ago"),
        "spread_pct": guarded_pct("spread", "buy_price"),
    })
    if one_document_per_run:
        df = df.withColumn("volume_rank", dense_rank_in_run("volume_idr"))
    else:
        df = dense_rank_desc(df, ["run_id"], "volume_idr", "volume_rank")
    derived = ["price_change_24h", "price_change_24h_pct", "price_change_7d",
               "price_change_7d_pct", "spread", "spread_pct", "volume_rank"]
    return df.select(*silver.columns, *derived)


# --- tabular Bronze forms of the payloads -----------------------------------
def tabular_pairs(payload: DataFrame, path: Column | str = "source_file") -> DataFrame:
    """Pair objects to the declared 11 columns; limits are not in the payload."""
    limits = ("price_decimal_places", "min_price", "max_price", "min_volume")
    types = {f.name: f.dataType for f in schemas.struct(schemas.PAIRS)}
    return payload.select(
        F.col("id").alias("pair"),
        "ticker_id",
        F.col("traded_currency_unit").alias("name"),
        F.upper(F.coalesce("base_currency", F.lit(""))).alias("base_currency"),
        F.upper(F.coalesce("traded_currency", F.lit(""))).alias("quote_currency"),
        *[F.lit(None).cast(types[c]).alias(c) for c in limits],
        file_captured_at(path).alias("created_at"),
        file_stem(path).alias("run_id"),
    )


def tabular_summaries(summaries: DataFrame, pairs: DataFrame,
                      path: Column | str = "source_file") -> DataFrame:
    """One row per ticker; a ticker without a listed pair keeps its own key."""
    per_run = "run_id" in pairs.columns and "run_id" in summaries.columns
    keys = ["run_id"] if per_run else []
    quotes = summaries.select(
        file_stem(path).alias("_stem"), *keys, F.explode("tickers").alias("_key", "t")
    )
    # A ticker listed twice goes to the pair listed last, if positions are known.
    last = F.max_by("id", "position") if "position" in pairs.columns else F.max("id")
    listed = (
        pairs.where(F.col("ticker_id").isNotNull())
        .groupBy(F.col("ticker_id").alias("_key"), *keys).agg(last.alias("_pair"))
    )

    def field(name: str) -> Column:
        return F.try_element_at("t", F.lit(name))

    return quotes.join(listed, ["_key", *keys], "left").select(
        F.coalesce("_pair", "_key").alias("pair"),
        field("last").alias("last"), field("buy").alias("buy"), field("sell").alias("sell"),
        field("high").alias("high"), field("low").alias("low"),
        dynamic_volume("t").alias("vol_coin"),
        field("vol_idr").alias("vol_idr"),
        epoch_to_timestamp_strict(field("server_time")).alias("created_at"),
        F.col("_stem").alias("run_id"),
    )
