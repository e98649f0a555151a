"""Every registered query against its SQL in DuckDB."""

import os
import sys

import duckdb
import pytest

import __spark_entry__ as entry

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from check import TABLES, compare  # noqa: E402

from marketloom.registry import ORACLE, QUERIES  # noqa: E402




@pytest.fixture(scope="module")
def con(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equals_sql(spark, con, sf_dir, name):
    detail, ok, *_ = compare(spark, con, name, QUERIES[name], ORACLE.get(name), sf_dir)
    assert ok, detail


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry_has_them_all():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_entry_is_lazy_and_named(spark):
    assert entry.entry(spark).columns[:2] == ["date", "symbol"]
