import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import build_session

    s = build_session(master="local[4]", shuffle_partitions=8, app_name="tidemark-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck_small():
    from tidemark.plans.compare import duckdb_connection

    return duckdb_connection(SF_SMALL)


@pytest.fixture(scope="session")
def tables_small(spark):
    from tidemark.sources.tables import Tables

    return Tables(spark, SF_SMALL)
