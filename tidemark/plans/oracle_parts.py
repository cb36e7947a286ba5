"""Shared DuckDB CTE text for risk, fundamentals, analyst, insider and factor queries."""

from __future__ import annotations

import math

from tidemark.operators.fundamentals import FFILL_MAX_DAYS, FUND_VALUES
from tidemark.plans.oracle_pod import pod_ctes
from tidemark.plans.sqlkit import div, full, sln
from tidemark.sources.tables import oracle_with


def ctes(pairs) -> str:
    return ",\n".join(f"{n} AS ({b})" for n, b in pairs)


F252 = "(PARTITION BY permno ORDER BY date ROWS BETWEEN 251 PRECEDING AND CURRENT ROW)"
PAIRS = f"count(CASE WHEN r IS NOT NULL AND r_market IS NOT NULL THEN 1 END) OVER {F252}"


def risk_ctes(src: str) -> list[tuple[str, str]]:
    return [
        ("rk0", f"SELECT p.*, {sln('1 + i.vwretd')} AS r_market FROM {src} p LEFT JOIN raw_dsi i ON p.date = i.date"),
        ("rk1", f"""SELECT *, CASE WHEN {PAIRS} >= 252 THEN regr_slope(r, r_market) OVER {F252} END AS beta_1y,
  CASE WHEN count(r) OVER {F252} >= 252 THEN quantile_cont(r, 0.05) OVER {F252} END AS VaR_95,
  CASE WHEN {PAIRS} >= 252 THEN sqrt(greatest(var_samp(r) OVER {F252} - regr_slope(r, r_market) OVER {F252}
    * regr_slope(r, r_market) OVER {F252} * var_samp(r_market) OVER {F252}, 0)) END AS idiosyncratic_vol,
  {div('close', 'high_60')} - 1 AS _dd FROM rk0"""),
        ("rk", f"SELECT * EXCLUDE (_dd), {full('min', '_dd', 60)} AS max_drawdown_60d FROM rk1"),
    ]


def pod_risk_sql_ctes(upto: int = 5) -> str:
    """bars -> pod passes -> risk columns, ending in CTE ``rk``."""
    return oracle_with("bars", "raw_dsi") + ",\n" + ctes(pod_ctes(upto) + risk_ctes(f"pod_p{upto}"))


def pod_risk_pairs(upto: int = 5) -> list[tuple[str, str]]:
    return pod_ctes(upto) + risk_ctes(f"pod_p{upto}")


def _ttm(c: str) -> str:
    return f"(CASE WHEN count({c}) OVER wq >= 4 THEN sum({c}) OVER wq END)"


def _ytd(c: str) -> str:
    return f"(CASE WHEN fqtr = 1 THEN {c} WHEN lag(fqtr) OVER wy = fqtr - 1 THEN {c} - lag({c}) OVER wy END)"


FUND_Q = [
    ("fq0", f"""SELECT *, {_ytd('oancfy')} AS _cfo_q, {_ytd('capxy')} AS _capx_q, {_ytd('ivncfy')} AS _cfi_q
  FROM fundq WINDOW wy AS (PARTITION BY gvkey, fyearq ORDER BY fqtr)"""),
    ("fq1", """SELECT a.*, b.revtq AS revtq_4ago, b.epspxq AS epspxq_4ago FROM fq0 a
  LEFT JOIN fundq b ON a.gvkey = b.gvkey AND a.fyearq = b.fyearq + 1 AND a.fqtr = b.fqtr"""),
    ("fq", f"""SELECT gvkey, datadate, rdq, fyearq, fqtr, coalesce(rdq, datadate + 90) AS eff, ceqq AS book_equity,
  {_ttm('epspxq')} AS EPS_ttm, {_ttm('oibdpq')} AS EBITDA_ttm, dlttq + dlcq - cheq AS net_debt,
  {_ttm('_cfo_q')} AS operating_cashflow, {_ttm('_capx_q')} AS capex, {_ttm('_cfi_q')} AS CFI_ttm,
  {_ttm('niq')} AS net_income_ttm, {_ttm('revtq')} AS revenue_ttm, {_ttm('cogsq')} AS COGS_ttm,
  atq AS total_assets, dlttq + dlcq AS total_debt, revtq AS revenue_q, revtq_4ago AS revenue_q_4ago,
  epspxq AS EPS_q, epspxq_4ago AS EPS_q_4ago, cshoq AS shares_outstanding_q
  FROM fq1 WINDOW wq AS (PARTITION BY gvkey ORDER BY datadate ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)"""),
    ("fl", """SELECT l.lpermno AS permno, fq.* FROM fq JOIN ccm_link l ON fq.gvkey = l.gvkey
  AND fq.datadate >= l.linkdt AND (l.linkenddt IS NULL OR fq.datadate <= l.linkenddt)"""),
    ("fd", "SELECT * FROM fl QUALIFY row_number() OVER (PARTITION BY permno, eff ORDER BY datadate DESC) = 1"),
]


def fund_asof_cte(panel: str, name: str = "fa") -> tuple[str, str]:
    vals = FUND_VALUES + ["datadate"]
    fresh = f"f.eff IS NOT NULL AND datediff('day', f.eff, b.date) <= {FFILL_MAX_DAYS}"
    cols = ", ".join(f"CASE WHEN {fresh} THEN f.{c} END AS {c}" for c in vals)
    return (name, f"SELECT b.*, {cols}, CASE WHEN {fresh} THEN f.eff END AS eff FROM {panel} b "
                  f"ASOF LEFT JOIN fd f ON b.permno = f.permno AND b.date >= f.eff")


CONS = ("cons", """SELECT permno, CAST(last_day(estdate) AS DATE) AS statpers, fpedats, count(est) AS numest,
  avg(est) AS meanest, stddev_samp(est) AS stdev FROM ibes_detail GROUP BY permno, CAST(last_day(estdate) AS DATE), fpedats""")
ACT = ("act", """SELECT l.lpermno AS permno, f.rdq AS anndats, f.datadate AS fpedats, f.epspxq AS actual FROM fundq f
  JOIN ccm_link l ON f.gvkey = l.gvkey AND f.datadate >= l.linkdt AND (l.linkenddt IS NULL OR f.datadate <= l.linkenddt)
  WHERE f.rdq IS NOT NULL""")
EVENTS = [
    CONS, ACT,
    ("ev1", """SELECT a.*, a.anndats - 30 AS _look, c.meanest AS c_meanest, c.numest AS c_numest, c.stdev AS c_stdev FROM act a
  ASOF LEFT JOIN cons c ON a.permno = c.permno AND a.fpedats = c.fpedats AND a.anndats > c.statpers"""),
    ("ev2", """SELECT e.*, c.meanest AS p_meanest FROM ev1 e
  ASOF LEFT JOIN cons c ON e.permno = c.permno AND e.fpedats = c.fpedats AND e._look >= c.statpers"""),
    ("ev", f"""SELECT permno, anndats AS earnings_date, fpedats, actual AS EPS_actual, c_meanest AS EPS_consensus,
  p_meanest AS EPS_consensus_t_30, c_numest AS analyst_count, {div('actual - c_meanest', 'abs(c_meanest)')} AS earnings_surprise,
  {div('c_meanest - p_meanest', 'abs(p_meanest)')} AS earnings_revision_30d,
  CASE WHEN c_numest >= 3 THEN {div('c_stdev', 'abs(c_meanest)')} END AS analyst_dispersion FROM ev2"""),
]
EVENT_VALUES = ["earnings_surprise", "earnings_revision_30d", "analyst_dispersion"]


def event_asof_cte(panel: str, name: str = "ea") -> tuple[str, str]:
    fresh = f"e.earnings_date IS NOT NULL AND datediff('day', e.earnings_date, b.date) <= {FFILL_MAX_DAYS}"
    cols = ", ".join(f"CASE WHEN {fresh} THEN e.{c} END AS {c}" for c in EVENT_VALUES)
    return (name, f"SELECT b.*, {cols} FROM {panel} b ASOF LEFT JOIN "
                  "(SELECT * FROM ev QUALIFY row_number() OVER (PARTITION BY permno, earnings_date ORDER BY fpedats DESC) = 1) e ON b.permno = e.permno AND b.date >= e.earnings_date")


INS_DAILY = ("ins_d", """SELECT permno, trade_date AS date, sum(CASE WHEN transaction_type = 'P' THEN shares ELSE 0 END) AS bought,
  sum(CASE WHEN transaction_type = 'S' THEN shares ELSE 0 END) AS sold FROM form4 WHERE transaction_type IN ('P', 'S')
  GROUP BY permno, trade_date""")
W90 = "(PARTITION BY permno ORDER BY date RANGE BETWEEN INTERVAL 89 DAYS PRECEDING AND CURRENT ROW)"


def insider_panel_ctes(panel: str) -> list[tuple[str, str]]:
    return [
        INS_DAILY,
        ("ins_u", f"""SELECT permno, date, 1 AS _panel, CAST(NULL AS DOUBLE) AS bought, CAST(NULL AS DOUBLE) AS sold FROM {panel}
  UNION ALL SELECT permno, date, NULL, bought, sold FROM ins_d"""),
        ("ins_w", f"""SELECT permno, date, _panel, coalesce(sum(bought) OVER {W90}, 0) AS insider_shares_bought,
  coalesce(sum(sold) OVER {W90}, 0) AS insider_shares_sold FROM ins_u"""),
        ("ins_p", """SELECT permno, date, insider_shares_bought, insider_shares_sold,
  CASE WHEN insider_shares_sold > 0 THEN insider_shares_bought / insider_shares_sold END AS insider_buy_sell_ratio
  FROM ins_w WHERE _panel = 1"""),
    ]


SQRT252 = repr(math.sqrt(252.0))
PRICE_FACTOR_SQL = {
    "ret_12m_skip1m": div("P_21 - P_252", "P_252"),
    "ret_1m": div("close - P_21", "P_21"),
    "mom_12m_minus_6m": f"{div('close', 'P_252')} - {div('close', 'P_126')}",
    "price_vs_200d_ma": f"{div('close', 'SMA_200')} - 1",
    "ma_50_vs_200": f"{div('SMA_50', 'SMA_200')} - 1",
    "vol_20d": f"std_r_20 * {SQRT252}",
    "downside_vol_20d": f"std_r_down_20 * {SQRT252}",
    "vol_ratio_20_60": div("std_r_20", "std_r_60"),
    "amihud_illiquidity": "amihud_20 * CAST(1000000 AS DOUBLE)",
    "avg_dollar_volume_20d": "dv_20",
    "bid_ask_spread_proxy": div("2 * hl", "high + low"),
    "RSI_14": f"CASE WHEN avg_loss_14 > 0 THEN 100 - {div('CAST(100 AS DOUBLE)', '1 + ' + div('avg_gain_14', 'avg_loss_14'))} "
              "WHEN avg_loss_14 = 0 AND avg_gain_14 > 0 THEN CAST(100 AS DOUBLE) END",
    "MACD_histogram": "MACD_hist",
    "bollinger_bandwidth": "BB_width",
    "distance_52w_high": f"{div('close', 'high_252')} - 1",
}
FUND_FACTOR_SQL = {
    "book_to_market": div("book_equity * CAST(1000000 AS DOUBLE)", "market_cap"),
    "earnings_yield": div("EPS_ttm", "close"),
    "ebitda_to_ev": div("EBITDA_ttm * CAST(1000000 AS DOUBLE)", "market_cap + net_debt * CAST(1000000 AS DOUBLE)"),
    "free_cashflow_yield": div("(operating_cashflow - capex) * CAST(1000000 AS DOUBLE)", "market_cap"),
    "gross_profitability": div("revenue_ttm - COGS_ttm", "total_assets"),
    "ROE": f"CASE WHEN book_equity > 0 THEN {div('net_income_ttm', 'book_equity')} END",
    "sloan_accruals": div("net_income_ttm - operating_cashflow - CFI_ttm", "total_assets"),
    "debt_to_equity": f"CASE WHEN book_equity > 0 THEN {div('total_debt', 'book_equity')} END",
    "revenue_growth": f"{div('revenue_q', 'revenue_q_4ago')} - 1",
    "earnings_growth": div("EPS_q - EPS_q_4ago", "abs(EPS_q_4ago)"),
}
