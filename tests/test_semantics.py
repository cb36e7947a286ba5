"""Hand-built micro-cases: one per place where a naive translation answers differently."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions.semantics import clip_lower, ewm_mean, ratio, safe_ln, sum_or_zero
from tidemark.operators import clean as C
from tidemark.operators.factors import rsi
from tidemark.operators.flags import cleaner_flags, nine_rule_flags
from tidemark.operators.joins import asof_join


def d(s):
    return dt.date.fromisoformat(s)


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(1, None), (2, -0.1), (3, 0.2)], "i int, r double")
    got = [r.r_up for r in df.select("i", clip_lower("r", 0.0).alias("r_up")).orderBy("i").collect()]
    assert got == [None, 0.0, 0.2]


def test_ratio_and_log_guards(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 2.0)], "a double, b double")
    rows = df.select(ratio("a", "b").alias("q"), safe_ln("a").alias("l")).collect()
    assert rows[0].q is None and rows[1].q == 0.0 and rows[1].l is None


def test_zero_volatility_drops_row(spark):
    rows = [(1, d("2000-01-01") + dt.timedelta(days=i), 0.01) for i in range(31)]
    df = spark.createDataFrame(rows, "permno long, date date, ret double")
    out = C.ts_outlier_filter(df)
    # std over 30 equal returns is 0: |ret| < 0 is false, rows with a 30-row std are dropped
    assert out.count() == 29


def test_one_stock_on_a_date(spark):
    df = spark.createDataFrame([(1, d("2000-01-03"), 0.05)], "permno long, date date, ret double")
    assert C.cs_outlier_filter(df, "ret").count() == 0
    clipped = C.cs_outlier_clip(df.withColumnRenamed("ret", "ret_clean")).collect()
    assert clipped[0].ret_clean == 0.05


def _flag_frame(spark, rows):
    return spark.createDataFrame(rows, "permno long, date date, row_id long, open double, high double, low double, "
                                       "close double, volume long")


def test_open_zero_flags_differ(spark):
    df = _flag_frame(spark, [(1, d("2000-01-03"), 1, 0.0, 11.0, 9.0, 10.0, 100)])
    cleaner = cleaner_flags(df).collect()[0].flags
    nine = nine_rule_flags(df, "2001-01-01").collect()[0].flags
    assert cleaner & 8  # INTRADAY_SPIKE: unguarded close/open
    assert not nine & 16  # nine-rule guards open != 0


def test_merged_flags_max_vs_or(spark):
    df = spark.createDataFrame([(1, d("2000-01-03"), 1, 2, 10, 0.01, 0.01, 10.0, 9.0, 10.0, 10.0),
                                (1, d("2000-01-03"), 2, 5, 20, 0.01, 0.01, 10.0, 9.0, 10.0, 10.0)],
                               "permno long, date date, row_id long, flags int, volume long, ret double, retx double, "
                               "high double, low double, open double, close double")
    assert C.dedupe_nine_rule(df).collect()[0].flags == 5
    assert C.dedupe_nine_rule(df, merge_flags="or").collect()[0].flags == 7


def test_all_null_volume_sums_to_zero(spark):
    df = spark.createDataFrame([(1, None), (1, None)], "k int, v long")
    assert df.groupBy("k").agg(sum_or_zero("v").alias("s")).collect()[0].s == 0


def test_late_filing_visible_from_report_date(spark):
    panel = spark.createDataFrame([(1, d("2000-04-30")), (1, d("2000-05-02"))], "permno long, date date")
    facts = spark.createDataFrame([(1, d("2000-05-02"), d("2000-03-30"), 7.0)], "permno long, eff date, datadate date, v double")
    got = {r.date: r.v for r in asof_join(panel, facts, "permno", "date", "eff", ["v"], tie_cols=["datadate"]).collect()}
    assert got[d("2000-04-30")] is None and got[d("2000-05-02")] == 7.0


def test_stale_filing_is_null(spark):
    panel = spark.createDataFrame([(1, d("2001-01-27")), (1, d("2001-01-26"))], "permno long, date date")
    facts = spark.createDataFrame([(1, d("2000-01-02"), 1.0)], "permno long, eff date, v double")
    got = {r.date: r.v for r in asof_join(panel, facts, "permno", "date", "eff", ["v"], max_age_days=390).collect()}
    assert got[d("2001-01-27")] is None  # 391 days
    assert got[d("2001-01-26")] == 1.0  # 390 days


def test_rsi_no_losses(spark):
    df = spark.createDataFrame([(0.01, 0.0), (0.0, 0.0), (0.01, 0.01)], "g double, l double")
    got = [r.x for r in df.select(rsi(F.col("g"), F.col("l")).alias("x")).collect()]
    assert got == [100.0, None, 50.0]


def test_ewm_matches_pandas_adjusted(spark):
    import numpy as np
    import pandas as pd

    xs = [float(x) for x in np.random.default_rng(1).normal(50, 2, 300)]
    xs[0] = None
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i long, x double")
    w = Window.partitionBy(F.lit(1)).orderBy("i")
    got = [r.e for r in df.select("i", ewm_mean("x", 14, w, F.col("i")).alias("e")).orderBy("i").collect()]
    want = pd.Series(xs, dtype="float64").ewm(span=14, adjust=True, ignore_na=False).mean().tolist()
    assert got[0] is None
    assert max(abs(a - b) for a, b in zip(got[1:], want[1:])) < 1e-9


def test_factor_catalogue_lineage(spark):
    from tidemark.operators.pod import POD_COLUMNS
    from tidemark.sources import metadata as MD

    cat = MD.factor_catalogue(spark)
    assert MD.lineage_gaps(cat, POD_COLUMNS + ["close", "high", "low"]).count() == 0


def test_ewm_beyond_the_double_range_is_an_error(spark):
    import pytest

    w = Window.partitionBy(F.lit(1)).orderBy("i")
    df = spark.range(1100).select(F.col("id").alias("i"), F.lit(1.0).alias("x"))
    with pytest.raises(Exception, match="smaller chunks"):
        df.select(ewm_mean("x", 3, w, F.col("i"))).collect()
    assert df.filter("i < 900").select(ewm_mean("x", 3, w, F.col("i")).alias("e")).filter("abs(e - 1) < 1e-9").count() == 900
