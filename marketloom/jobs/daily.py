"""Daily run: staged tables to intermediate models, marts and checks."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.jobs.increments import load_slice
from marketloom.operators.upsert import upsert
from marketloom.plans import marts, models
from marketloom.quality import rules, suites
from marketloom.session import fit_shuffle, materialize
from marketloom.sinks.tables import mart_path


def stage_all(bronze: Mapping[str, DataFrame], now: datetime | None = None) -> dict[str, DataFrame]:
    """Stage every Bronze table given; all rows of a run carry the same stamp."""
    stamp = F.lit(now or datetime.now(timezone.utc)).cast("timestamp")
    staged = [m for m in models.declared(stamp) if m.layer == models.STAGING]
    built = models.build(staged, {f"bronze.{name}": df for name, df in bronze.items()})
    return {m.name: built[m.key] for m in staged if m.key in built}


def intermediate(staged: Mapping[str, DataFrame], unique_orders: bool = False) -> dict[str, DataFrame]:
    """The five intermediate models; lazy, so they inline into their users."""
    upper = [m for m in models.declared(unique_orders=unique_orders) if m.layer == models.INTERMEDIATE]
    read = {i for m in upper for i in m.inputs}
    built = models.build(upper, {i: staged[i.split(".")[1]] for i in read})
    return {m.name: built[m.key] for m in upper}


def read_mart(spark: SparkSession, root: str, mart: str) -> DataFrame:
    """All rows of a mart, for a downstream load."""
    return spark.read.parquet(mart_path(root, mart))


def run_daily(spark: SparkSession, bronze: Mapping[str, DataFrame], root: str,
              now: datetime | None = None, check: bool = True, batch: int | None = None) -> dict[str, list]:
    """Build and upsert the four marts; returns the touched dates per mart.

    The business mart is built from the merged marts, so it sees their history.
    With ``check`` the run stops at the first layer that breaks a rule. With a
    ``batch`` number the tables are a slice of rows that no other number has
    brought: it is added to what earlier slices left, and only the dates that it
    changes are made anew. The staging rules then hold within the slice.
    """
    at = now or datetime.now(timezone.utc)
    stamp = F.lit(at).cast("timestamp")
    fit_shuffle(spark, *bronze.values())
    # The checks and several models read the staged tables: each source is read once, for all of them.
    staged = {name: materialize(df, f"staging-{name}") for name, df in stage_all(bronze, at).items()}
    if check:
        rules.require(rules.run_rules(staged, suites.model_rules()))
    if batch is not None:
        return load_slice(spark, root, staged, batch, at)
    # The staging rules include the uniqueness of order ids.
    made = intermediate(staged, unique_orders=check)
    # An order with its trades breaks its two rules just where the order does, which is checked above.
    del made["orders_trades"]
    # The aggregates are small and used by checks and marts: compute them once.
    made = {name: materialize(df, name) for name, df in made.items()}
    if check:
        rules.require(rules.run_rules(made, suites.model_rules()))
        _require_empty(singular_checks(staged, made))

    touched = {}
    built = {
        "market_daily": marts.market_daily(made["daily_market"], stamp),
        "trading_daily": marts.trading_daily(made["daily_trading"], stamp),
        "user_activity_daily": marts.user_activity_daily(made["user_events_daily"], stamp),
    }
    with ThreadPoolExecutor(max_workers=len(built)) as pool:
        loads = {m: pool.submit(upsert, spark, mart_path(root, m), df, marts.GRAIN[m]) for m, df in built.items()}
        touched.update({m: load.result() for m, load in loads.items()})
    stored = {m: spark.read.schema(df.schema).parquet(mart_path(root, m)) for m, df in built.items()}
    business = marts.business_metrics(stored["market_daily"], stored["trading_daily"],
                                      stored["user_activity_daily"], stamp)
    if check:
        _require_empty({"business_metric_consistency": suites.inconsistent_business(business)})
    touched["business_metrics"] = upsert(
        spark, mart_path(root, "business_metrics"), business, marts.GRAIN["business_metrics"])
    return touched


def singular_checks(staged: Mapping[str, DataFrame], made: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    checks = {
        "orders_filled_quantity": suites.filled_above_quantity(staged["orders"]),
        "no_orphan_trades": suites.orphan_trades(staged["trades"], staged["orders"]),
        "positive_prices": suites.non_positive_prices(staged["orders"], staged["summaries"]),
        "non_negative_volumes": suites.negative_volumes(made["daily_market"], made["daily_trading"]),
    }
    if "accounts" in staged:
        checks["account_balances"] = suites.negative_balances(staged["accounts"])
    return checks


def _require_empty(checks: Mapping[str, DataFrame]) -> None:
    failed = [name for name, bad in checks.items() if not bad.isEmpty()]
    if failed:
        raise rules.DataQualityError("Data quality validation failed:\n" + "\n".join(f"- {f}" for f in failed))
