"""Every registered query against its DuckDB oracle on the smallest tables."""

import duckdb
import pytest

from quarry.plans.catalog import ORACLE, QUERIES
from tools_compare import rows_of  # noqa: F401  (shared normaliser)

SF = "/root/testdata/sf0.001"
TABLES = ["documents", "embeddings", "pages", "benchmark", "labels", "conversations", "events"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    s_cols = sorted(df.columns)
    s_rows = [r.asDict(recursive=True) for r in df.collect()]
    if name not in ORACLE:
        assert s_rows is not None
        return
    rel = con.sql(ORACLE[name])
    assert sorted(rel.columns) == s_cols
    d_rows = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
    assert rows_of(s_rows, s_cols) == rows_of(d_rows, s_cols)
