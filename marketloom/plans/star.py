"""Star schema: market and date dimensions, snapshot fact, insert-if-absent loads."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom import schemas
from marketloom.functions import as_date, date_key
from marketloom.operators.dedup import absent_from, keep_first
from marketloom.operators.ranking import with_row_index
from marketloom.sinks.tables import TableStore


class MissingMarketError(ValueError):
    """A snapshot row refers to a pair the market dimension does not hold."""


def new_markets(gold: DataFrame, dim_market: DataFrame) -> DataFrame:
    """Markets not yet known, keyed from the current maximum upwards by pair id.

    Of several rows for a pair the earliest wins. Rows are reduced to one per
    pair in the scan's own tasks; only those are compared and numbered.
    """
    highest = dim_market.agg(F.coalesce(F.max("market_key"), F.lit(0))).first()[0]
    earliest = gold.where("pair_id IS NOT NULL").groupBy("pair_id").agg(
        F.min(F.struct("captured_at", "ticker_id", "asset_name")).alias("_first"))
    numbered = with_row_index(absent_from(earliest, dim_market, ["pair_id"]), ["pair_id"], "_n")
    return numbered.select(
        (F.lit(highest) + F.col("_n")).cast("bigint").alias("market_key"),
        "pair_id", "_first.ticker_id", "_first.asset_name",
    )


def date_dimension(gold: DataFrame, at: str = "captured_at") -> DataFrame:
    """One row per date found in ``at``."""
    return (
        gold.select(as_date(at).alias("full_date")).where(F.col("full_date").isNotNull()).distinct()
        .select(
            date_key("full_date").alias("date_key"), "full_date",
            F.year("full_date").alias("year"), F.month("full_date").alias("month"),
            F.dayofmonth("full_date").alias("day"),
        )
    )


def new_dates(gold: DataFrame, dim_date: DataFrame) -> DataFrame:
    return absent_from(date_dimension(gold), dim_date, ["date_key"])


def new_facts(gold: DataFrame, dim_market: DataFrame, fact: DataFrame,
              on_missing: str = "drop") -> DataFrame:
    """Snapshot rows whose (market, captured_at) is not in the fact table yet.

    The key is unique and never null: of several rows of a batch with one key
    the smallest in column order is loaded, and rows without ``captured_at`` are
    left out (``quality.rules.quarantine`` keeps them). ``on_missing="drop"``
    leaves out rows of unknown markets, ``"raise"`` fails and lists them.
    """
    gold = gold.where("captured_at IS NOT NULL")
    if on_missing == "raise":
        require_markets(gold, dim_market)
    measures = [c for c in schemas.columns(schemas.FACT_SNAPSHOT) if c not in ("market_key", "date_key")]
    keyed = gold.join(dim_market.select("market_key", "pair_id"), "pair_id", "inner").select(
        "market_key", date_key("captured_at").alias("date_key"), *measures
    )
    rest = [c for c in keyed.columns if c not in ("market_key", "captured_at")]
    return keep_first(absent_from(keyed, fact, ["market_key", "captured_at"]), ["market_key", "captured_at"], rest)


def require_markets(gold: DataFrame, dim_market: DataFrame, show: int = 100) -> None:
    """Raise if a pair has no market; the message lists up to ``show`` of them."""
    missing = absent_from(gold.select("pair_id").distinct(), dim_market, ["pair_id"])
    found = [r.pair_id for r in missing.orderBy("pair_id").limit(show + 1).collect()]
    if found:
        more = " and more" if len(found) > show else ""
        raise MissingMarketError(f"Market key not found for pair_id: {found[:show]}{more}")


def touched_dates(df: DataFrame, column: str) -> list:
    """Distinct dates of a batch: at most one value per calendar day."""
    return sorted(r[0] for r in df.select(column).distinct().collect() if r[0] is not None)


@dataclass
class StarLoad:
    markets: int
    dates: int
    facts: int


def load_market_snapshot(spark: SparkSession, gold: DataFrame, store: TableStore,
                         on_missing: str = "drop") -> StarLoad:
    """Load dim_market, dim_date and the fact, in that order.

    ``gold`` is read several times, so pass a stored or kept frame. Every step inserts only what is absent, so a load that died half-way is
    completed by running it again.
    """
    store.create_star()

    markets = store.append(new_markets(gold, store.read("dim_market")), "dim_market")
    dates = store.append(new_dates(gold, store.read("dim_date")), "dim_date")

    keys = touched_dates(gold.select(date_key("captured_at").alias("k")), "k")
    # Only the touched date partitions can hold the batch's keys.
    fact = store.read_partitions("fact_market_snapshot", "date_key", keys)
    facts = store.append(
        new_facts(gold, store.read("dim_market"), fact, on_missing),
        "fact_market_snapshot", partition_by="date_key",
    )
    return StarLoad(markets, dates, facts)


# --- reports over the star --------------------------------------------------
def dim_market_head(dim_market: DataFrame, n: int = 10) -> DataFrame:
    return dim_market.orderBy("market_key").limit(n)


def dim_date_listing(dim_date: DataFrame) -> DataFrame:
    return dim_date.orderBy("date_key")


def latest_facts(fact: DataFrame, dim_market: DataFrame, n: int = 10) -> DataFrame:
    """The newest fact rows with their pair.

    The rows are picked before the join; each has one market, so the outcome
    is the same. Facts without a market are no part of the report, hence the
    semi join below the limit.
    """
    markets = dim_market.select("market_key", "pair_id")
    top = (
        fact.join(markets.select("market_key"), "market_key", "left_semi")
        .orderBy(F.col("captured_at").desc(), "market_key").limit(n)
    )
    return (
        top.join(markets, "market_key")
        .select("market_key", "pair_id", "date_key", "captured_at", "run_id", "last_price",
                "price_change_24h_pct", "spread_pct", "volume_rank")
        .orderBy(F.col("captured_at").desc(), "market_key")
    )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table, in one job."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count") for name, df in tables.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
