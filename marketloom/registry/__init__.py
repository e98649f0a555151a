"""Every query the engine exposes over the test tables."""

from marketloom.registry import checks, market, snapshot, storage  # noqa: F401
from marketloom.registry.catalog import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
