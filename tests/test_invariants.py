"""Invariants of the factor chain and the cleaners (sf0.001)."""

from pyspark.sql import functions as F

from tidemark.operators import clean as C
from tidemark.operators.flags import nine_rule_flags
from tidemark.operators.merge import merge_nine_rule
from tidemark.operators.pod import build_pod
from tidemark.operators.prep import zscore
from tidemark.plans.q_factors import price_factor_frame


def test_factor_bounds(tables_small):
    pf = price_factor_frame(tables_small)
    row = pf.agg(F.max("distance_52w_high").alias("dmax"), F.min("RSI_14").alias("rmin"),
                 F.max("RSI_14").alias("rmax")).collect()[0]
    assert row.dmax is None or row.dmax <= 1e-12
    assert row.rmin is None or (row.rmin >= 0 and row.rmax <= 100)


def test_zscore_mean_zero(tables_small):
    pf = zscore(price_factor_frame(tables_small), ["ret_1m"])
    worst = pf.groupBy("date").agg(F.abs(F.avg("ret_1m_z")).alias("m")).agg(F.max("m")).collect()[0][0]
    assert worst is None or worst < 1e-9


def test_flags_fit_nine_bits(tables_small):
    t = tables_small.dict("raw_dsf", "raw_dsenames", "raw_dsfhdr", "delistings", "raw_dsi")
    f = nine_rule_flags(merge_nine_rule(t), "1998-09-01")
    assert f.agg(F.max("flags")).collect()[0][0] < 512


def test_cleaners_row_counts(tables_small):
    t = tables_small.dict("raw_dsf", "raw_dsenames", "raw_dsfhdr", "delistings", "raw_dsi")
    d = C.dedupe_nine_rule(nine_rule_flags(merge_nine_rule(t), "1998-09-01"))
    n = d.count()
    ts = C.ts_outlier_filter(d)
    assert ts.count() <= n
    assert C.cs_outlier_filter(ts).count() <= ts.count()
    dc = d.withColumn("ret_total", F.col("ret"))
    assert C.ts_outlier_clip(dc).count() == n
    assert C.cs_outlier_clip(C.ts_outlier_clip(dc)).count() == n


def test_chunked_pod_equals_whole_series(tables_small):
    cols = ["r", "P_252", "SMA_200", "std_r_252", "high_252", "EMA_9", "OBV", "SMA_200_lag5"]
    whole = build_pod(tables_small["bars"], upto=2).select("permno", "date", *cols)
    split = build_pod(tables_small["bars"], upto=2, chunk_rows=300, halo_rows=260).select("permno", "date", *cols)
    assert split.count() == whole.count()
    diff = whole.alias("a").join(split.alias("b"), ["permno", "date"]).select(
        *[F.max(F.abs(F.col(f"a.{c}") - F.col(f"b.{c}"))).alias(c) for c in cols]).collect()[0]
    for c in cols:
        assert diff[c] is None or diff[c] < 1e-6, c


def test_no_look_ahead(tables_small):
    """Features dated <= T are unchanged when every input after T is removed."""
    cut = "1996-06-30"
    bars = tables_small["bars"]
    cols = ["SMA_50", "EMA_26", "std_r_60", "MACD_signal", "stoch_d"]
    full = build_pod(bars, upto=5).filter(F.col("date") <= cut).select("permno", "date", *cols)
    part = build_pod(bars.filter(F.col("date") <= cut), upto=5).select("permno", "date", *cols)
    j = full.alias("a").join(part.alias("b"), ["permno", "date"], "full_outer")
    assert j.filter(F.col("a.SMA_50").isNull() != F.col("b.SMA_50").isNull()).count() == 0
    worst = j.select(*[F.max(F.abs(F.col(f"a.{c}") - F.col(f"b.{c}"))).alias(c) for c in cols]).collect()[0]
    for c in cols:
        assert worst[c] is None or worst[c] < 1e-9, c


def test_bars_builder_equals_recipe(spark, duck_small):
    from tidemark.functions.semantics import round_doubles
    from tidemark.plans.compare import compare
    from tidemark.plans.sqlkit import r6
    from tidemark.sources.tables import Tables, oracle_with

    from conftest import SF_SMALL

    sql = (oracle_with("bars") + " SELECT permno, date, volume, shares_outstanding, "
           + ", ".join(r6(c, c) for c in ["open", "high", "low", "close"]) + " FROM bars")
    assert compare(round_doubles(Tables(spark, SF_SMALL)["bars"]), duck_small, sql)["match"]


def test_falling_prices_over_chunk_boundaries(spark):
    """A series that falls from 100,000 to 0.5 over several chunks of the default size."""
    import datetime as dt

    import numpy as np
    from numpy.lib.stride_tricks import sliding_window_view

    n = 5000
    rng = np.random.default_rng(3)
    close = np.exp(np.linspace(np.log(1e5), np.log(0.5), n) + 0.01 * rng.normal(size=n))
    rows = [(1, dt.date(2000, 1, 1) + dt.timedelta(days=i), float(c), float(c * 1.01), float(c * 0.99), float(c), 1000, 10)
            for i, c in enumerate(close)]
    bars = spark.createDataFrame(rows, "permno long, date date, open double, high double, low double, close double, "
                                       "volume long, shares_outstanding long")
    got = build_pod(bars, upto=3).select("date", "std_P_20", "SMA_200", "BB_width").orderBy("date").toPandas()
    w20, w200 = sliding_window_view(close, 20), sliding_window_view(close, 200)
    std, mean = w20.std(axis=1, ddof=1)[-4000:], w20.mean(axis=1)[-4000:]
    for name, want, tol in (("std_P_20", std, 1e-9), ("SMA_200", w200.mean(axis=1)[-4000:], 1e-6), ("BB_width", 4 * std / mean, 1e-6)):
        assert np.abs(got[name].astype(float).to_numpy()[-4000:] / want - 1).max() < tol, name
