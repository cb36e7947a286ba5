"""Every registered query against its DuckDB oracle on the sf0.001 tables; rows-only ones must run."""

import pytest

from tidemark.plans.catalog import load_all, spark_query
from tidemark.plans.compare import compare

from conftest import SF_SMALL

QUERIES = load_all()
WITH_SQL = sorted(n for n, q in QUERIES.items() if q.sql)
ROWS_ONLY = sorted(n for n, q in QUERIES.items() if not q.sql)


@pytest.mark.parametrize("name", WITH_SQL)
def test_matches_oracle(spark, duck_small, name):
    res = compare(spark_query(name, spark, SF_SMALL), duck_small, QUERIES[name].sql)
    assert res["cols_match"], (res["spark_cols"], res["oracle_cols"])
    assert res["spark_rows"] == res["oracle_rows"]
    assert res["match"], res.get("examples")


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_rows_only_runs(spark, name):
    assert spark_query(name, spark, SF_SMALL).count() >= 0
