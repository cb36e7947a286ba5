"""DuckDB oracle text for the pod: plain whole-series windows, EWM by bounded list frames."""

from __future__ import annotations

from tidemark.operators.pod import LAGS, PASS1, PASS2, PASS3, PASS4, PASS5
from tidemark.plans.sqlkit import clip_hi, clip_lo, div, ewm_from_list, ewm_list, full, sln

W = "(PARTITION BY permno ORDER BY date)"
RUN = "(PARTITION BY permno ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def pod_ctes(upto: int = 5, source: str = "bars") -> list[tuple[str, str]]:
    """(name, body) CTEs ending with ``pod_p{upto}``; ``source`` has the bar columns."""
    ctes = []
    lags = ", ".join(f"lag(close, {n}) OVER {W} AS P_{n}" for n in LAGS)
    ctes.append(("pod_l", f"SELECT permno, date, open, high, low, close, volume, shares_outstanding, {lags} FROM {source}"))
    ctes.append(("pod_a", f"""SELECT *, {sln(div('close', 'P_1'))} AS r, {div('close', 'P_1')} - 1 AS r_1d,
  high - low AS hl, {sln(div('high', 'low'))} AS log_hl, {sln(div('close', 'open'))} AS log_co,
  close * volume AS dv, close - P_1 AS dP, close * shares_outstanding AS market_cap,
  abs(high - P_1) AS hc1, abs(low - P_1) AS lc1 FROM pod_l"""))
    ctes.append(("pod_p1", f"""SELECT *, {clip_lo('r')} AS r_up, {clip_hi('r')} AS r_down, {clip_lo('r_1d')} AS rsi_gain,
  {clip_lo('-r_1d')} AS rsi_loss, log_hl * log_hl AS log_hl_sq, log_co * log_co AS log_co_sq, abs(r) AS abs_r,
  CAST(sign(r) AS DOUBLE) AS obv_sign FROM pod_a"""))
    if upto < 2:
        return ctes
    lists = {"EMA_9": ("close", 9), "EMA_12": ("close", 12), "EMA_20": ("close", 20), "EMA_26": ("close", 26),
             "avg_gain_14": ("rsi_gain", 14), "avg_loss_14": ("rsi_loss", 14)}
    list_cols = ", ".join(f"{ewm_list(x, s)} AS _l_{name}" for name, (x, s) in lists.items())
    ctes.append(("pod_b", f"""SELECT *,
  {full('avg', 'close', 20)} AS SMA_20, {full('avg', 'close', 50)} AS SMA_50, {full('avg', 'close', 200)} AS SMA_200,
  {full('stddev_samp', 'r', 20)} AS std_r_20, {full('stddev_samp', 'r', 60)} AS std_r_60,
  {full('stddev_samp', 'r', 120)} AS std_r_120, {full('stddev_samp', 'r', 252)} AS std_r_252,
  {full('stddev_samp', 'close', 20)} AS std_P_20, {full('stddev_samp', 'r_down', 20)} AS std_r_down_20,
  {full('stddev_samp', 'r_up', 20)} AS std_r_up_20, {full('max', 'high', 14)} AS high_14, {full('min', 'low', 14)} AS low_14,
  {full('max', 'high', 60)} AS high_60, {full('max', 'high', 252)} AS high_252, {full('min', 'low', 252)} AS low_252,
  greatest(hl, hc1, lc1) AS true_range, {full('avg', 'dv', 20)} AS dv_20, {div('abs_r', 'dv')} AS amihud_daily,
  lag(dP, 1) OVER {W} AS dP_lag1, {full('avg', 'volume', 20)} AS vol_mean_20,
  CASE WHEN obv_sign * volume IS NOT NULL THEN sum(obv_sign * volume) OVER {RUN} END AS OBV,
  {list_cols} FROM pod_p1"""))
    emas = ", ".join(f"{ewm_from_list('_l_' + name, s)} AS {name}" for name, (_, s) in lists.items())
    ctes.append(("pod_p2", f"""SELECT * EXCLUDE ({', '.join('_l_' + n for n in lists)}), {emas},
  lag(SMA_20, 5) OVER {W} AS SMA_20_lag5, lag(SMA_50, 5) OVER {W} AS SMA_50_lag5, lag(SMA_200, 5) OVER {W} AS SMA_200_lag5
  FROM pod_b"""))
    if upto < 3:
        return ctes
    ctes.append(("pod_p3", f"""SELECT *, EMA_12 - EMA_26 AS MACD, SMA_20 + 2 * std_P_20 AS BB_upper, SMA_20 - 2 * std_P_20 AS BB_lower,
  {div('(SMA_20 + 2 * std_P_20) - (SMA_20 - 2 * std_P_20)', 'SMA_20')} AS BB_width,
  {full('avg', 'true_range', 14)} AS ATR_14, {full('avg', 'amihud_daily', 20)} AS amihud_20,
  100 * {div('close - low_14', 'high_14 - low_14')} AS stoch_k, {sln('market_cap')} AS log_market_cap FROM pod_p2"""))
    if upto < 4:
        return ctes
    ctes.append(("pod_c", f"SELECT *, {ewm_list('MACD', 9)} AS _l_sig, {full('avg', 'stoch_k', 3)} AS stoch_d FROM pod_p3"))
    ctes.append(("pod_p4", f"SELECT * EXCLUDE (_l_sig), {ewm_from_list('_l_sig', 9)} AS MACD_signal FROM pod_c"))
    if upto < 5:
        return ctes
    ctes.append(("pod_p5", "SELECT *, MACD - MACD_signal AS MACD_hist FROM pod_p4"))
    return ctes


def pass_columns(upto: int) -> list[str]:
    return (PASS1 + (PASS2 if upto >= 2 else []) + (PASS3 if upto >= 3 else [])
            + (PASS4 if upto >= 4 else []) + (PASS5 if upto >= 5 else []))
