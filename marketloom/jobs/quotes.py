"""Keep the daily market model and its mart current from slices of quotes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.operators.dateindex import DateIndex
from marketloom.operators.partials import Mergeable, PartialStore
from marketloom.operators.upsert import upsert
from marketloom.plans import daily, marts
from marketloom.session import materialize
from marketloom.sinks.tables import mart_path
from marketloom.storage import read_partitions


def market_model(tie_break: Column | str | None = None) -> Mergeable:
    return Mergeable(lambda ticks: daily.market_states(ticks, tie_break), daily.merge_market, daily.finish_market)


def refresh_market_mart(spark: SparkSession, root: str, rows: DataFrame, now: Column | None = None) -> list:
    """Bring the mart up to date with new rows of the stored daily market; returns the dates it rewrote.

    The change of a day rests on the close of the symbol's previous day, so a
    late day also alters the one after it. An index of each symbol's dates names
    both neighbours, and only the partitions of touched dates and of these are
    read, however long the history is.
    """
    index = DateIndex(spark, f"{root}/state/market_dates", rows.schema["symbol"].dataType.simpleString())
    keys = rows.select("date", "symbol")
    index.add(keys)
    near = index.neighbours(keys)
    affected = materialize(
        near.select("date", "symbol", "previous")
        .union(near.where("next IS NOT NULL").select("next", "symbol", "date")).distinct(), "affected-days")
    dates = [r[0] for r in affected.select(F.explode(F.array("date", "previous"))).distinct().collect()]
    model = read_partitions(spark, f"{root}/daily_market", rows.schema, "date", dates)
    close = model.select(F.col("date").alias("_day"), F.col("symbol").alias("_s"), F.col("close_price").alias("_previous"))
    own = affected.select(F.col("date").alias("_d"), F.col("symbol").alias("_k"), "previous")
    found = (
        model.join(own, F.col("date").eqNullSafe(F.col("_d")) & F.col("symbol").eqNullSafe(F.col("_k")))
        .join(close, (F.col("previous") == F.col("_day")) & F.col("symbol").eqNullSafe(F.col("_s")), "left")
    )
    return upsert(spark, mart_path(root, "market_daily"), marts.market_daily_against(found, now),
                  marts.GRAIN["market_daily"], unique=True)


def load_quotes(spark: SparkSession, root: str, quotes: DataFrame, batch: int,
                tie_break: Column | str | None = None, now: Column | None = None) -> list:
    """Add a slice of staged quotes; returns the dates whose mart rows were rewritten.

    The dates come from the slice's own rows, so quotes that arrive late for an
    old date are counted. Each quote is read once: what is stored is the slice's
    states per date and symbol, and a day is made from the states of its slices.
    A slice loaded again under its number replaces itself, and finishes what a
    failure has left undone.
    """
    store = PartialStore(spark, f"{root}/state/market", market_model(tie_break))
    dates = store.add(quotes, batch)
    if not dates:
        return []
    rows = materialize(store.current(dates), "daily-market")
    upsert(spark, f"{root}/daily_market", rows, marts.GRAIN["market_daily"], unique=True)
    return refresh_market_mart(spark, root, rows, now)
