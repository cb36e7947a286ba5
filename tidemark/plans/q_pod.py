"""Feature pod passes (H-01..H-65) and the risk columns (E-08, E-09, J-09..J-12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.clean import first_in_order
from tidemark.operators.merge import adjust_from_start, normalise_dsf
from tidemark.operators.pod import PASS1, PASS2, PASS3, PASS4, PASS5, RISK, build_pod
from tidemark.plans.catalog import query
from tidemark.plans.oracle_parts import ctes, pod_risk_sql_ctes
from tidemark.plans.oracle_pod import pod_ctes
from tidemark.plans.sqlkit import div, r6
from tidemark.sources.tables import oracle_with


# Price impact per dollar is of the order 1e-7: these queries report it per million dollars, like the
# factor, so that six decimals keep its digits.
PER_MILLION = ("amihud_daily", "amihud_20")
MILLION = 1_000_000.0


def _pod_sql(cols: list[str], upto: int) -> str:
    body = oracle_with("bars") + ",\n" + ctes(pod_ctes(upto))
    value = {c: f"{c} * CAST({MILLION} AS DOUBLE)" if c in PER_MILLION else c for c in cols}
    return f"{body}\nSELECT permno, date, {', '.join(r6(v, c) for c, v in value.items())} FROM pod_p{upto}"


def _reported(cols: list[str]):
    return [(F.col(c) * MILLION).alias(c) if c in PER_MILLION else F.col(c) for c in cols]


@query("h_pod_pass1", _pod_sql(PASS1, 1))
def h_pod_pass1(t):
    """H-01..H-24: raw transforms (returns, clips, ranges, lags, market cap)."""
    return build_pod(t["bars"], upto=1).select("permno", "date", *PASS1)


@query("h_pod_pass2", _pod_sql(PASS2, 2))
def h_pod_pass2(t):
    """H-25..H-54: rolling means/stds/extremes, EWMs, OBV, lags of SMAs."""
    return build_pod(t["bars"], upto=2).select("permno", "date", *_reported(PASS2))


@query("h_pod_pass3_5", _pod_sql(PASS3 + PASS4 + PASS5, 5))
def h_pod_pass3_5(t):
    """H-55..H-65: MACD, Bollinger, ATR, Amihud, stochastics, MACD signal and histogram."""
    return build_pod(t["bars"], upto=5).select("permno", "date", *_reported(PASS3 + PASS4 + PASS5))


@query("e08_risk_columns", f"""
{pod_risk_sql_ctes(2)}
SELECT permno, date, {', '.join(r6(c, c) for c in RISK)} FROM rk
""")
def e08_risk_columns(t):
    """C-10, E-08, E-09, J-09..J-12: market return, beta, VaR 95, idiosyncratic vol, 60-day drawdown."""
    return build_pod(t["bars"], upto=2, market=t["raw_dsi"]).select("permno", "date", *RISK)


ADJUSTED_OUT = ["r", "r_1d", "P_21", "market_cap", "SMA_20", "SMA_200", "EMA_26", "std_r_60", "high_252", "true_range", "dv_20",
                "avg_gain_14", "BB_width", "log_market_cap", "MACD_hist"]
RAW_BARS = ["open", "high", "low", "close", "volume", "shares_outstanding", "cfacpr", "cfacshr"]
ADJUSTED_SQL = [
    ("raw1", """SELECT permno, date, abs(openprc) AS open, askhi AS high, bidlo AS low, abs(prc) AS close, vol AS volume,
  shrout * 1000 AS shares_outstanding, cfacpr, cfacshr FROM raw_dsf
  QUALIFY row_number() OVER (PARTITION BY permno, date ORDER BY vol DESC NULLS FIRST, row_id) = 1"""),
    ("fact", """SELECT permno, arg_min(cfacpr, date) FILTER (cfacpr <> 0) AS p0, arg_min(cfacshr, date) FILTER (cfacshr <> 0) AS s0
  FROM raw1 GROUP BY permno"""),
    ("adj", f"""SELECT permno, date, {', '.join(f"{c} * {div('p0', 'cfacpr')} AS {c}" for c in RAW_BARS[:4])},
  {', '.join(f"{c} * {div('cfacshr', 's0')} AS {c}" for c in RAW_BARS[4:6])} FROM raw1 JOIN fact USING (permno)"""),
]


@query("h_pod_adjusted", f"""
{oracle_with('raw_dsf')},
{ctes(ADJUSTED_SQL + pod_ctes(5, 'adj'))}
SELECT permno, date, {', '.join(r6(c, c) for c in ADJUSTED_OUT)} FROM pod_p5
""")
def h_pod_adjusted(t):
    """B-19, H: the pod over prices, volume and shares adjusted for splits as known on each day; the copy with the
    highest volume of each day of the raw file."""
    raw = normalise_dsf(t["raw_dsf"])
    bars = raw.groupBy("permno", "date").agg(first_in_order(RAW_BARS)).select("permno", "date", "_first.*")
    return build_pod(adjust_from_start(bars), upto=5).select("permno", "date", *ADJUSTED_OUT)
