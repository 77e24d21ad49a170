"""Every registered query against its DuckDB SQL on the sf0.001 tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from oracle_check import rows_of  # noqa: E402
from tillroll.plans import catalog, oracle  # noqa: E402
from tillroll.sources.driver_views import TABLES  # noqa: E402

from conftest import SMOKE_DIR  # noqa: E402


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE_DIR}/{t}.parquet')")
    return con


def test_every_query_of_the_engine_has_sql():
    assert set(catalog.queries()) == set(oracle.oracle_sql())
    assert set(catalog.queries()) <= set(entry.queries())


@pytest.mark.parametrize("key", sorted(catalog.queries()))
def test_query_matches_oracle(spark, duck, key):
    sdf = entry.queries()[key](spark, SMOKE_DIR)
    srows = [tuple(r) for r in sdf.collect()]
    res = duck.execute(entry.oracle_sql()[key])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert rows_of(srows, sdf.columns) == rows_of(drows, dcols)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["Country", "TotalAmount", "TransactionCount"]
    assert df.count() > 0
