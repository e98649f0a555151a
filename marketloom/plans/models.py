"""The staging and intermediate models, each with the tables it is made from.

A model is a function of its inputs. ``build`` makes them in the order of their
inputs and stores those that several others read, so a source is read once
however many models hang on it; all others stay plans within their users.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import partial
from graphlib import TopologicalSorter

from pyspark.sql import Column, DataFrame

from marketloom.plans import daily, staging
from marketloom.session import materialize
from marketloom.sources.catalog import BRONZE_TABLES

STAGING, INTERMEDIATE = "staging", "intermediate"


@dataclass(frozen=True)
class Model:
    name: str
    layer: str
    inputs: tuple[str, ...]
    build: Callable[..., DataFrame]

    @property
    def key(self) -> str:
        return f"{self.layer}.{self.name}"


def _staged(name: str, stamp: Column | None) -> Model:
    made = partial(staging.stage_user_events, now=stamp) if name == "user_events" else (
        lambda df: staging.stage(name, df, stamp))
    return Model(name, STAGING, (f"bronze.{name}",), made)


def declared(stamp: Column | None = None, tie_break: str = "run_id", unique_orders: bool = False) -> list[Model]:
    """The nine staging and five intermediate models; all rows of a run carry the same stamp."""
    orders, trades, events, quotes = (f"{STAGING}.{n}" for n in ("orders", "trades", "user_events", "summaries"))
    return [
        *[_staged(name, stamp) for name in BRONZE_TABLES],
        Model("daily_market", INTERMEDIATE, (quotes,), lambda q: daily.daily_market(q, tie_break)),
        Model("orders_trades", INTERMEDIATE, (orders, trades), daily.orders_trades),
        Model("daily_trading", INTERMEDIATE, (orders, trades), partial(daily.daily_trading, unique_orders=unique_orders)),
        Model("user_events_daily", INTERMEDIATE, (events,), daily.user_events_daily),
        Model("user_trading_activity", INTERMEDIATE, (orders, trades, events), daily.user_trading_activity),
    ]


def build(models: list[Model], sources: Mapping[str, DataFrame],
          store: Callable[[DataFrame, str], DataFrame] = materialize) -> dict[str, DataFrame]:
    """All models that the sources suffice for; sources and models go by ``layer.name``.

    A model whose inputs are missing is left out, as are those made from it. A
    source that no model reads and inputs that lead in a circle are errors.
    """
    by_key = {m.key: m for m in models}
    readers = Counter(i for m in models for i in m.inputs)
    unknown = sorted(k for k in sources if k not in readers)
    if unknown:
        raise KeyError(f"no model reads {', '.join(unknown)}")
    built = dict(sources)
    for key in TopologicalSorter({k: m.inputs for k, m in by_key.items()}).static_order():
        model = by_key.get(key)
        if model and all(i in built for i in model.inputs):
            df = model.build(*[built[i] for i in model.inputs])
            built[key] = store(df, key.replace(".", "-")) if readers[key] > 1 else df
    return {k: df for k, df in built.items() if k in by_key}
