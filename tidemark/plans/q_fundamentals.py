"""Fundamentals, analysts, insiders: E-10..E-14, C-08..C-12, D-06, I-01..I-26, L-01, L-02."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import analysts as AN
from tidemark.operators import fundamentals as FU
from tidemark.operators import insiders as IN
from tidemark.plans.catalog import query
from tidemark.plans.oracle_parts import EVENTS, FUND_Q, INS_DAILY, W90, ctes, fund_asof_cte
from tidemark.plans.sqlkit import r6
from tidemark.sources.tables import oracle_with

QF = ["book_equity", "EPS_ttm", "EBITDA_ttm", "net_debt", "operating_cashflow", "capex", "CFI_ttm", "net_income_ttm",
      "revenue_ttm", "COGS_ttm", "total_assets", "total_debt", "revenue_q", "revenue_q_4ago", "EPS_q", "EPS_q_4ago",
      "shares_outstanding_q"]
EV_FLOATS = ["EPS_actual", "EPS_consensus", "EPS_consensus_t_30", "earnings_surprise", "earnings_revision_30d",
             "analyst_dispersion"]
# Fixed value: earnings-event surprise threshold (L-01).
SURPRISE_MIN = 0.15


def _r(cols):
    return ", ".join(r6(c, c) for c in cols)


@query("i01_fundamentals_quarterly", f"""
{oracle_with('fundq')},
{ctes(FUND_Q[:3])}
SELECT gvkey, datadate, eff, {_r(QF)} FROM fq
""")
def i01_fundamentals_quarterly(t):
    """E-10..E-12, I-01..I-17: TTM sums, year-ago quarter, YTD differencing, effective date."""
    return FU.quarterly_columns(t["fundq"]).select("gvkey", "datadate", "eff", *QF)


@query("c08_fundamentals_asof", f"""
{oracle_with('bars', 'fundq', 'ccm_link')},
{ctes(FUND_Q + [fund_asof_cte('bars')])}
SELECT permno, date, datadate, eff, {_r(QF)} FROM fa
""")
def c08_fundamentals_asof(t):
    """C-07..C-09: daily point-in-time fundamentals (eff <= date, newest datadate on ties, 390-day limit)."""
    d = FU.daily_fundamentals(t["bars"].select("permno", "date"), t["fundq"], t["ccm_link"])
    return d.select("permno", "date", "datadate", "eff", *QF)


@query("i18_analyst_events", f"""
{oracle_with('fundq', 'ccm_link', 'ibes_detail')},
{ctes(EVENTS)}
SELECT permno, earnings_date, fpedats, analyst_count, {_r(EV_FLOATS)} FROM ev
""")
def i18_analyst_events(t):
    """C-11, C-12, D-06, I-18..I-23, J-31..J-33: per announcement, consensus before and 30 days before."""
    ev = AN.earnings_events(FU.announcements(t["fundq"], t["ccm_link"]), t["ibes_detail"])
    return ev.select("permno", "earnings_date", "fpedats", "analyst_count", *EV_FLOATS)


@query("l01_earnings_surprise_events", f"""
{oracle_with('fundq', 'ccm_link', 'ibes_detail')},
{ctes(EVENTS)}
SELECT permno, earnings_date, {_r(['EPS_actual', 'EPS_consensus', 'earnings_surprise'])} FROM ev
WHERE abs(earnings_surprise) >= {SURPRISE_MIN}
""")
def l01_earnings_surprise_events(t):
    """L-01: earnings events with |surprise| >= 15%."""
    ev = AN.earnings_events(FU.announcements(t["fundq"], t["ccm_link"]), t["ibes_detail"])
    return ev.filter(F.abs("earnings_surprise") >= SURPRISE_MIN).select(
        "permno", "earnings_date", "EPS_actual", "EPS_consensus", "earnings_surprise")


@query("e13_insider_trailing", f"""
{oracle_with('form4')},
{ctes([INS_DAILY])}
SELECT permno, date, {r6(f'sum(bought) OVER {W90}', 'insider_shares_bought')}, {r6(f'sum(sold) OVER {W90}', 'insider_shares_sold')},
  {r6(f'CASE WHEN sum(sold) OVER {W90} > 0 THEN sum(bought) OVER {W90} / sum(sold) OVER {W90} END', 'insider_buy_sell_ratio')}
FROM ins_d
""")
def e13_insider_trailing(t):
    """E-13, I-24..I-26, J-35: open-market shares bought/sold over 90 calendar days, buy/sell ratio."""
    return IN.trailing_insider(IN.daily_insider(t["form4"]))


@query("e14_insider_clusters", f"""
{oracle_with('form4')},
b AS (SELECT DISTINCT permno, trade_date AS date, filer FROM form4 WHERE transaction_type = 'P')
SELECT DISTINCT permno, date, count(DISTINCT filer) OVER (PARTITION BY permno ORDER BY date RANGE BETWEEN INTERVAL 29 DAYS PRECEDING AND CURRENT ROW) AS cluster_insiders FROM b
""")
def e14_insider_clusters(t):
    """E-14: distinct insiders buying within 30 calendar days, per buying day."""
    return IN.insider_clusters(t["form4"]).withColumn("cluster_insiders", F.col("cluster_insiders").cast("bigint"))


@query("l02_insider_cluster_events", f"""
{oracle_with('form4')},
b AS (SELECT DISTINCT permno, trade_date AS date, filer FROM form4 WHERE transaction_type = 'P'),
c AS (SELECT DISTINCT permno, date, count(DISTINCT filer) OVER (PARTITION BY permno ORDER BY date RANGE BETWEEN INTERVAL 29 DAYS PRECEDING AND CURRENT ROW) AS cluster_insiders FROM b)
SELECT * FROM c WHERE cluster_insiders >= 3
""")
def l02_insider_cluster_events(t):
    """L-02: insider-cluster events (3+ distinct buyers within 30 days)."""
    return IN.cluster_events(t["form4"]).withColumn("cluster_insiders", F.col("cluster_insiders").cast("bigint"))
