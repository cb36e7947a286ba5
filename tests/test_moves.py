"""Wide rows move no more often than the method needs: plans and small tables instead of figures."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import pod as P
from tidemark.operators import prep as PR
from tidemark.operators.series import earlier_chunks


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def bars(spark, rows, securities=(1, 2)):
    start = dt.date(2000, 1, 3)
    data = [(k, start + dt.timedelta(days=i), 10.0, 11.0, 9.0, 10.0 + (i * (k + 3)) % 7, 100 + i % 5, 1000) for k in securities for i in range(rows)]
    return spark.createDataFrame(data, "permno long, date date, open double, high double, low double, close double, volume long, shares_outstanding long")


def test_cross_sections_do_not_move_the_rows(spark):
    df = bars(spark, 40).select("permno", "date", "close")
    for out in (PR.zscore(df, ["close"]), PR.winsorise(df, ["close"]), PR.zscore(PR.winsorise(df, ["close"]), ["close"], store=False)):
        assert "Exchange hashpartitioning" not in plan(out) and "Sort [" not in plan(out)
        assert out.count() == 80


def test_bars_are_not_moved_by_date_for_the_market(spark):
    b = bars(spark, 40)
    market = b.groupBy("date").agg((F.avg("close") / 1000).alias("vwretd"))
    out = P.with_market(b, market)
    assert "Exchange hashpartitioning(date" not in plan(out)
    assert out.filter("r_market IS NOT NULL").count() == 80


def test_running_obv_reads_only_chunks_that_others_follow(spark):
    b = bars(spark, 300)
    assert earlier_chunks(P.split_bars(b)).isEmpty()
    split = P.split_bars(b, 100, 90)
    assert {r[0] for r in earlier_chunks(split).select("_chunk").distinct().collect()} == {0, 1}
    got, want = (P.build_pod(b, upto=2, chunk_rows=n, halo_rows=90).select("permno", "date", "OBV").collect() for n in (100, 2048))
    assert sorted(got) == sorted(want) and len(got) == 600


def test_value_at_risk_sorts_primitives(spark):
    b = bars(spark, 30)
    out = P.build_pod(b, upto=2, market=b.groupBy("date").agg(F.avg("volume").alias("vwretd"))).select("permno", "VaR_95")
    assert "array_sort(" not in plan(out) and "sort_array(" in plan(out)
