"""Physical plan checks: pushdown into the scan, partition pruning, no cross joins."""

from pyspark.sql import functions as F

from tidemark.plans.catalog import spark_query
from tidemark.sources import extracts as X
from tidemark.sources import lake

from conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_extract_pushes_filters_and_prunes_columns(spark):
    df = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").filter(F.col("l_quantity") > 10).select("l_orderkey")
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,10.0)]" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan


def test_partitioned_scan_prunes(spark, tables_small):
    path = lake.write_partitioned(tables_small["bars"].select("permno", "date", "close"), spark, "bars-test")
    df = lake.read_partitioned(spark, path).filter((F.col("year") == 1997) & (F.col("month") == 3))
    plan = _plan(df)
    assert "PartitionFilters: [isnotnull(year" in plan and "(month" in plan


def test_no_cartesian_products_or_python(spark):
    from tidemark.plans.catalog import load_all

    # streaming and model builders run their streams / fits while building; they are
    # exercised by the oracle and rows-only tests
    names = sorted(n for n, q in load_all().items() if q.sql and not n.startswith("m0"))
    for name in names:
        plan = _plan(spark_query(name, spark, SF_SMALL))
        for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
            assert node not in plan, (name, node)


def test_date_range_validation():
    import pytest

    with pytest.raises(ValueError):
        X.DateRange.of("2020-02-01", "2020-01-01")
    with pytest.raises(ValueError):
        X.DateRange.of(None, "2020-01-01")
    assert X.DateRange.of("2020-01-01", "2020-01-31").end.day == 31


def test_required_and_nonempty(spark, tables_small):
    import pytest

    with pytest.raises(ValueError):
        lake.require_tables({"raw_dsf": 1}, ["raw_dsf", "raw_dsi"])
    assert lake.is_nonempty(tables_small["bars"])
    assert not lake.is_nonempty(tables_small["bars"].filter("permno < 0"))


def test_static_and_dated_paths():
    assert lake.table_path("/lake", "raw_dsenames", "2020-01-01", "2020-12-31") == "/lake/raw_dsenames"
    assert lake.table_path("/lake", "raw_dsf", "2020-01-01", "2020-12-31") == "/lake/raw_dsf_2020-01-01_2020-12-31"
