"""Names under which Bronze tables are registered as views."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# The nine source tables and the kind of system each comes from. Fixed values.
BRONZE_TABLES = {
    "users": "relational", "accounts": "relational", "assets": "relational",
    "orders": "relational", "trades": "relational", "transactions": "relational",
    "user_events": "documents",
    "pairs": "api", "summaries": "api",
}


def view_name(layer: str, name: str) -> str:
    return f"{layer}_{name}"


def register_views(tables: dict[str, DataFrame], layer: str = "bronze") -> list[str]:
    """Expose DataFrames as temporary views; plans stay inlined into their users."""
    names = []
    for name, df in tables.items():
        if layer == "bronze" and name not in BRONZE_TABLES:
            raise KeyError(f"unknown Bronze table: {name}")
        df.createOrReplaceTempView(view_name(layer, name))
        names.append(view_name(layer, name))
    return names


def list_views(spark: SparkSession, layer: str = "bronze") -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables() if t.name.startswith(f"{layer}_"))


def register_models(built: Mapping[str, DataFrame]) -> list[str]:
    """Views of models given by ``layer.name``, each in its layer; returns the views' names."""
    names = []
    for key, df in built.items():
        layer, name = key.split(".", 1)
        names += register_views({name: df}, layer)
    return names
