"""Feature pod: 65 reusable per-security columns in five dependency passes.

All passes run over one split of the series (``series.split_series``), dealt by
permno: one Exchange of the bars for the whole pod, none for its wider rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.semantics import (
    Prefix, clip_lower, clip_upper, ewm_mean, full, ratio, roll_count, roll_extreme, roll_mean, roll_quantile,
    roll_slope, roll_std, roll_var, safe_ln,
)
from tidemark.operators.series import (
    DEFAULT_CHUNK_ROWS, POD_HALO_ROWS, chunk_window, drop_halo, series_running_sum, split_series, total_before,
    with_series_index,
)
from tidemark.session import written

KEY = "permno"
BAR_COLUMNS = ["permno", "date", "open", "high", "low", "close", "volume", "shares_outstanding"]

LAGS = (1, 5, 21, 63, 126, 252)

PASS1 = ["r", "r_1d", "r_up", "r_down", "rsi_gain", "rsi_loss", "hl", "log_hl", "log_co", "log_hl_sq",
         "log_co_sq", "abs_r", "dv", "dP", "obv_sign", "P_1", "P_5", "P_21", "P_63", "P_126", "P_252",
         "market_cap", "hc1", "lc1"]
PASS2 = ["SMA_20", "SMA_50", "SMA_200", "EMA_9", "EMA_12", "EMA_20", "EMA_26", "std_r_20", "std_r_60",
         "std_r_120", "std_r_252", "std_P_20", "std_r_down_20", "std_r_up_20", "high_14", "low_14",
         "high_60", "high_252", "low_252", "true_range", "dv_20", "amihud_daily", "avg_gain_14",
         "avg_loss_14", "OBV", "dP_lag1", "SMA_20_lag5", "SMA_50_lag5", "SMA_200_lag5", "vol_mean_20"]
PASS3 = ["MACD", "BB_upper", "BB_lower", "BB_width", "ATR_14", "amihud_20", "stoch_k", "log_market_cap"]
PASS4 = ["MACD_signal", "stoch_d"]
PASS5 = ["MACD_hist"]
POD_COLUMNS = PASS1 + PASS2 + PASS3 + PASS4 + PASS5


def split_bars(bars: DataFrame, chunk_rows: int = DEFAULT_CHUNK_ROWS, halo_rows: int = POD_HALO_ROWS) -> DataFrame:
    indexed = with_series_index(bars, KEY, [F.col("date")], first_of=("close",))
    return split_series(indexed, KEY, chunk_rows, halo_rows)


def pass1(df: DataFrame) -> DataFrame:
    w = chunk_window(KEY)
    c = F.col("close")
    df = df.select("*", *[F.lag(c, n).over(w).alias(f"P_{n}") for n in LAGS])
    p1 = F.col("P_1")
    df = df.withColumns({
        "r": safe_ln(ratio(c, p1)),
        "r_1d": ratio(c, p1) - 1,
        "hl": F.col("high") - F.col("low"),
        "log_hl": safe_ln(ratio("high", "low")),
        "log_co": safe_ln(ratio(c, "open")),
        "dv": c * F.col("volume"),
        "dP": c - p1,
        "market_cap": c * F.col("shares_outstanding"),
        "hc1": F.abs(F.col("high") - p1),
        "lc1": F.abs(F.col("low") - p1),
    })
    df = df.withColumns({
        "r_up": clip_lower("r", 0.0),
        "r_down": clip_upper("r", 0.0),
        "rsi_gain": clip_lower("r_1d", 0.0),
        "rsi_loss": clip_lower(-F.col("r_1d"), 0.0),
        "log_hl_sq": F.col("log_hl") * F.col("log_hl"),
        "log_co_sq": F.col("log_co") * F.col("log_co"),
        "abs_r": F.abs("r"),
        "obv_sign": F.signum("r"),
    })
    return df


def pass2(df: DataFrame) -> DataFrame:
    w = chunk_window(KEY)
    df = df.withColumn("_obv_step", F.col("obv_sign") * F.col("volume"))
    df = df.withColumn("_obv_before", total_before(KEY, "_obv_step"))
    df = series_running_sum(df, KEY, "_obv_step", "OBV", "_obv_before").drop("_obv_step", "_obv_before")
    p = F.col("_p")
    pre = Prefix(w, centers={"close": "_first_close"})
    for x in ("r", "r_down", "r_up"):
        pre.count(x), pre.s1(x), pre.s2(x)
    for x in ("close", "dv", "volume", "high", "low"):
        pre.count(x), pre.s1(x)
    df = pre.apply(df)

    def extreme(x: str, n: int, fn: str):
        return F.when(roll_count(w, x, n) >= n, roll_extreme(w, x, n, fn))

    cols = {
        "SMA_20": roll_mean(w, "close", 20),
        "SMA_50": roll_mean(w, "close", 50),
        "SMA_200": roll_mean(w, "close", 200),
        "EMA_9": ewm_mean("close", 9, w, p),
        "EMA_12": ewm_mean("close", 12, w, p),
        "EMA_20": ewm_mean("close", 20, w, p),
        "EMA_26": ewm_mean("close", 26, w, p),
        "std_r_20": roll_std(w, "r", 20),
        "std_r_60": roll_std(w, "r", 60),
        "std_r_120": roll_std(w, "r", 120),
        "std_r_252": roll_std(w, "r", 252),
        # prices can fall by orders of magnitude within a series: no running sums of their squares
        "std_P_20": full(F.stddev_samp, "close", w, 20),
        "std_r_down_20": roll_std(w, "r_down", 20),
        "std_r_up_20": roll_std(w, "r_up", 20),
        "high_14": full(F.max, "high", w, 14),
        "low_14": full(F.min, "low", w, 14),
        "high_60": extreme("high", 60, "max"),
        "high_252": extreme("high", 252, "max"),
        "low_252": extreme("low", 252, "min"),
        "true_range": F.greatest("hl", "hc1", "lc1"),
        "dv_20": roll_mean(w, "dv", 20),
        "amihud_daily": ratio("abs_r", "dv"),
        "avg_gain_14": ewm_mean("rsi_gain", 14, w, p),
        "avg_loss_14": ewm_mean("rsi_loss", 14, w, p),
        "dP_lag1": F.lag("dP", 1).over(w),
        "vol_mean_20": roll_mean(w, "volume", 20),
    }
    df = df.withColumns(cols)
    df = df.withColumns({
        "SMA_20_lag5": F.lag("SMA_20", 5).over(w),
        "SMA_50_lag5": F.lag("SMA_50", 5).over(w),
        "SMA_200_lag5": F.lag("SMA_200", 5).over(w),
    })
    return _drop_prefix(df)


def _drop_prefix(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(("_pc_", "_p1_", "_p2_", "_pk_", "_pn_", "_q"))])


def pass3(df: DataFrame) -> DataFrame:
    w = chunk_window(KEY)
    pre = Prefix(w)
    pre.count("amihud_daily"), pre.s1("amihud_daily")
    df = pre.apply(df)
    df = df.withColumns({
        "MACD": F.col("EMA_12") - F.col("EMA_26"),
        "BB_upper": F.col("SMA_20") + 2 * F.col("std_P_20"),
        "BB_lower": F.col("SMA_20") - 2 * F.col("std_P_20"),
        "ATR_14": full(F.avg, "true_range", w, 14),
        "amihud_20": roll_mean(w, "amihud_daily", 20),
        "stoch_k": 100 * ratio(F.col("close") - F.col("low_14"), F.col("high_14") - F.col("low_14")),
        "log_market_cap": safe_ln("market_cap"),
    })
    return _drop_prefix(df.withColumn("BB_width", ratio(F.col("BB_upper") - F.col("BB_lower"), "SMA_20")))


def pass4(df: DataFrame) -> DataFrame:
    w = chunk_window(KEY)
    return df.withColumns({
        "MACD_signal": ewm_mean("MACD", 9, w, F.col("_p")),
        "stoch_d": full(F.avg, "stoch_k", w, 3),
    })


def pass5(df: DataFrame) -> DataFrame:
    return df.withColumn("MACD_hist", F.col("MACD") - F.col("MACD_signal"))


RISK = ["r_market", "beta_1y", "VaR_95", "idiosyncratic_vol", "max_drawdown_60d"]


def risk_pass(df: DataFrame) -> DataFrame:
    """E-08, E-09, J-09..J-12 over 252/60-row windows (needs pass 2 and ``r_market``)."""
    w = chunk_window(KEY)
    df = df.withColumn("_dd", ratio("close", "high_60") - 1)
    pre = Prefix(w)
    pre.pair("r", "r_market")
    for x in ("r", "r_market"):
        pre.count(x), pre.s1(x), pre.s2(x)
    pre.count("_dd")
    df = pre.apply(df)
    pairs, beta = roll_slope(w, "r", "r_market", 252)
    resid_var = roll_var(w, "r", 252, 2) - beta * beta * roll_var(w, "r_market", 252, 2)
    df = df.withColumns({
        "beta_1y": F.when(pairs >= 252, beta),
        "VaR_95": roll_quantile(w, "r", 252, 0.05, count=roll_count(w, "r", 252)),
        "idiosyncratic_vol": F.when(pairs >= 252, F.sqrt(F.greatest(resid_var, F.lit(0.0)))),
        "max_drawdown_60d": F.when(roll_count(w, "_dd", 60) >= 60, roll_extreme(w, "_dd", 60, "min")),
    })
    return _drop_prefix(df.drop("_dd"))


def with_market(bars: DataFrame, market: DataFrame) -> DataFrame:
    """C-10: r_market = ln(1 + vwretd) joined on date. The per-date table (bounded by the calendar) is written first, so
    that the planner knows its size: the bars are not moved by date for it."""
    m = written(market.select("date", safe_ln(1 + F.col("vwretd")).alias("r_market")), "market")
    return bars.join(m, "date", "left")


def build_pod(bars: DataFrame, upto: int = 5, chunk_rows: int = DEFAULT_CHUNK_ROWS,
              halo_rows: int = POD_HALO_ROWS, materialize: bool = False, market: DataFrame | None = None,
              obv: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """Bars plus pod columns of passes 1..``upto``, one row per (permno, date). ``keep``: other columns of ``bars`` that
    stay. Bars that already are dealt by security are not moved.

    ``materialize`` writes the split series as a Parquet table under the shared checkpoint folder and reads it back, for
    callers that read it often: the passes then move it once more. ``obv=False`` leaves OBV out.
    """
    base = bars.select(*BAR_COLUMNS, *keep)
    if market is not None:
        base = with_market(base, market)
    df = split_bars(base, chunk_rows, halo_rows)
    if materialize:
        df = written(df, "pod-split")
    out = run_passes(df, upto, market is not None)
    return out if obv else out.drop("OBV")


def run_passes(df: DataFrame, upto: int, risk: bool) -> DataFrame:
    """Passes 1..``upto`` (and the risk pass) over a split frame, without its helper columns and copies."""
    steps = [pass1, pass2, pass3, pass4, pass5]
    for step in steps[:upto]:
        df = step(df)
    if risk and upto >= 2:
        df = risk_pass(df)
    return drop_halo(df).drop("_i", "_first_close")


def recent_pod(bars: DataFrame, upto: int, market: DataFrame) -> DataFrame:
    """``build_pod`` of series that were cut to a bounded number of rows: each is one chunk, so rows dealt by security
    are neither indexed by year nor written nor moved again. Other columns of ``bars`` stay; OBV, which has no bound, is
    left out. Rows without a security are dropped, as there."""
    w = Window.partitionBy(KEY).orderBy("date")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    df = bars.filter(F.col(KEY).isNotNull())
    df = df.withColumns({"_i": F.row_number().over(w) - 1, "_first_close": F.first("close", ignorenulls=True).over(whole)})
    df = df.withColumns({"_p": F.col("_i"), "_chunk": F.lit(0).cast("long"), "_last_chunk": F.lit(0).cast("long"),
                         "_halo": F.lit(False)})
    return run_passes(with_market(df, market), upto, True).drop("OBV")
