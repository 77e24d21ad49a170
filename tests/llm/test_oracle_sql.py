"""The queries that SQL can express against their DuckDB SQL."""

import math

import duckdb
import pytest

from conftest import SMOKE_DIR
from tillroll.llm import queries


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE_DIR}/{t}.parquet')")
    df = queries.queries()[name](spark, SMOKE_DIR)
    res = con.execute(queries.oracle_sql()[name])
    columns = [d[0] for d in res.description]
    assert sorted(columns) == sorted(df.columns)

    def plain(rows):
        return sorted(tuple(round(x, 9) if isinstance(x, float) and math.isfinite(x) else x for x in r) for r in rows)

    assert plain(map(tuple, df.select(*columns).collect())) == plain(res.fetchall())
