"""Factors and cross-sectional preparation: J-01..J-35 (J-34 as a label), K-01..K-07."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import analysts as AN
from tidemark.operators import daystate as DS
from tidemark.operators import fundamentals as FU
from tidemark.operators import insiders as IN
from tidemark.operators import prep as PR
from tidemark.operators.factors import (
    EVENT_FACTORS, FACTOR_NAMES, FUNDAMENTAL_FACTORS, PRICE_FACTORS, RISK_FACTORS, fundamental_factors, price_factors,
)
from tidemark.operators.joins import attach_point_in_time
from tidemark.operators.pod import BAR_COLUMNS, build_pod
from tidemark.plans.catalog import query
from tidemark.plans.oracle_parts import (
    EVENT_VALUES, EVENTS, FUND_FACTOR_SQL, FUND_Q, PRICE_FACTOR_SQL, ctes, event_asof_cte, fund_asof_cte,
    insider_panel_ctes, pod_risk_pairs,
)
from tidemark.plans.sqlkit import r6
from tidemark.session import scratch_path
from tidemark.sources import lake
from tidemark.sources.tables import Tables, build_bars, oracle_with

PRICE_OUT = list(PRICE_FACTORS) + RISK_FACTORS + ["log_market_cap"]
FUND_OUT = list(FUNDAMENTAL_FACTORS)
# Fixed value: liquidity floor of the registered K-05 query (fixture dollar volumes are ~1e5).
FIXTURE_LIQUIDITY_FLOOR = 100_000
# Fixed value: the reported day of the incremental run (K-07) and the days its store is advanced.
INCREMENTAL_DAY = "1998-06-30"
INCREMENTAL_STEPS = 5
# Two engines that sum a constant cross-section in different orders disagree on whether its std is 0;
# the compared queries call anything below this share of |mean| constant.
ENGINE_NOISE = 1e-10


def _r(cols):
    return ", ".join(r6(c, c) for c in cols)


def _z_sql(c: str, part: str) -> str:
    m, sd = f"avg({c}) OVER (PARTITION BY {part})", f"stddev_samp({c}) OVER (PARTITION BY {part})"
    return f"CASE WHEN {sd} > 0 AND {sd} > abs({m}) * {ENGINE_NOISE!r} THEN ({c} - {m}) / {sd} END"


def price_factor_frame(t: Tables, bars: DataFrame | None = None, few: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """``few``: for callers that read few of the factors: none of the OBV. ``keep``: other columns of ``bars`` that stay."""
    pod = build_pod(t["bars"] if bars is None else bars, upto=5, market=t["raw_dsi"], obv=not few, keep=keep)
    return price_factors(pod).select("permno", "date", "close", "market_cap", *PRICE_OUT, *keep)


def fundamental_factor_frame(panel: DataFrame, t: Tables) -> DataFrame:
    d = FU.daily_fundamentals(panel, t["fundq"], t["ccm_link"])
    return fundamental_factors(d).drop(*FU.FUND_VALUES, "datadate", "eff")


def panel_rows(t: Tables, more: list[tuple] = ()) -> DataFrame:
    """K-06: one row per (permno, date) with the 34 same-day factors, close, and the values of ``more`` sources.

    Fundamentals (as of eff, newest datadate on ties, 390 days), analyst events (as of
    the announcement, 390 days) and trailing 90-day insider flows are attached in one
    window pass over the union of bars and side inputs. It comes before the pod, while rows are narrow: the pod finds
    them dealt by security, so the wide rows are not moved.
    """
    q = FU.linked_quarters(t["fundq"], t["ccm_link"])
    ev = AN.latest_period(AN.earnings_events(FU.announcements(t["fundq"], t["ccm_link"]), t["ibes_detail"]))
    bars = t["bars"].select("permno", "date", F.struct(*BAR_COLUMNS[2:]).alias("_bar"))
    known = attach_point_in_time(
        bars,
        [("fund", q, "eff", FU.FUND_VALUES, FU.FFILL_MAX_DAYS),
         ("event", ev.select("permno", "earnings_date", *EVENT_VALUES), "earnings_date", EVENT_VALUES,
          FU.FFILL_MAX_DAYS), *more],
        flows=(IN.daily_insider(t["form4"]), ["bought", "sold"], IN.TRAILING_DAYS),
    )
    values = [c for c in known.columns if c not in bars.columns]
    df = known.select("permno", "date", "_bar.*", F.struct(*values).alias("_known"))  # bars and facts share a name
    df = price_factor_frame(t, df, few=True, keep=("_known",)).select("*", "_known.*").drop("_known")
    return fundamental_factors(df).withColumn(
        "insider_buy_sell_ratio", F.when(F.col("sold") > 0, F.try_divide(F.col("bought"), F.col("sold"))))


def factor_panel(t: Tables) -> DataFrame:
    """K-06: (permno, date) and the 34 factors."""
    return panel_rows(t).select("permno", "date", *FACTOR_NAMES)


PF_CTE = ("pf", "SELECT permno, date, close, market_cap, "
          + ", ".join(f"{e} AS {n}" for n, e in PRICE_FACTOR_SQL.items())
          + ", " + ", ".join(RISK_FACTORS) + ", log_market_cap FROM rk")
FF_CTE = ("ff", "SELECT * EXCLUDE (" + ", ".join(FU.FUND_VALUES + ["datadate", "eff"]) + "), "
          + ", ".join(f"{e} AS {n}" for n, e in FUND_FACTOR_SQL.items()) + " FROM fa")
ALL_TABLES = ("bars", "raw_dsi", "fundq", "ccm_link", "ibes_detail", "form4")
PANEL_PAIRS = (pod_risk_pairs(5) + [PF_CTE] + FUND_Q + [fund_asof_cte("pf"), FF_CTE] + EVENTS
               + [event_asof_cte("ff")] + insider_panel_ctes("ea")
               + [("panel", "SELECT ea.*, ins_p.insider_buy_sell_ratio FROM ea JOIN ins_p ON ea.permno = ins_p.permno AND ea.date = ins_p.date")])
PANEL_WITH = oracle_with(*ALL_TABLES) + ",\n" + ctes(PANEL_PAIRS)


@query("j01_price_factors", f"""
{oracle_with('bars', 'raw_dsi')},
{ctes(pod_risk_pairs(5) + [PF_CTE])}
SELECT permno, date, {_r(PRICE_OUT)} FROM pf
""")
def j01_price_factors(t):
    """J-01..J-16, J-27..J-30: momentum, volatility, risk, liquidity, size and technical factors."""
    return price_factor_frame(t).select("permno", "date", *PRICE_OUT)


@query("j17_fundamental_factors", f"""
{oracle_with('bars', 'fundq', 'ccm_link')},
{ctes([('pb', 'SELECT permno, date, close, close * shares_outstanding AS market_cap FROM bars')] + FUND_Q + [fund_asof_cte('pb'), ('fa2', 'SELECT * FROM fa'), (FF_CTE[0], FF_CTE[1])])}
SELECT permno, date, {_r(FUND_OUT)} FROM ff
""")
def j17_fundamental_factors(t):
    """J-17..J-26: value, quality and growth factors from point-in-time fundamentals."""
    panel = t["bars"].select("permno", "date", "close", (F.col("close") * F.col("shares_outstanding")).alias("market_cap"))
    return fundamental_factor_frame(panel, t).select("permno", "date", *FUND_OUT)


@query("k06_factor_panel", f"""
{PANEL_WITH}
SELECT permno, date, {_r(FACTOR_NAMES)} FROM panel
""")
def k06_factor_panel(t):
    """K-06: the factor panel, 34 same-day factors per (permno, date) (J-34 is a label, see l03)."""
    return factor_panel(t)


@query("k02_factor_zscores", f"""
{PANEL_WITH}
SELECT permno, date, {', '.join(r6(_z_sql(c, 'date'), c + '_z') for c in FACTOR_NAMES)} FROM panel
""")
def k02_factor_zscores(t):
    """K-02: every factor z-scored within date."""
    return PR.zscore(factor_panel(t), FACTOR_NAMES, noise=ENGINE_NOISE).select("permno", "date", *[c + "_z" for c in FACTOR_NAMES])


# Interpolated percentiles of dollar volumes differ between engines in the 12th digit: compared in thousands.
IN_THOUSANDS, THOUSAND = ("avg_dollar_volume_20d",), 1000.0


def _winsor_sql(c):
    lo, hi = PR.WINSOR_SKEWED if c in PR.SKEWED_FACTORS else PR.WINSOR_DEFAULT
    lo_e = f"quantile_cont({c}, {lo}) OVER (PARTITION BY date)"
    hi_e = f"quantile_cont({c}, {hi}) OVER (PARTITION BY date)"
    return f"CASE WHEN {c} IS NOT NULL THEN least(greatest({c}, {lo_e}), {hi_e}) END"


@query("k01_winsorise", f"""
{PANEL_WITH}
SELECT permno, date, {', '.join(r6(_winsor_sql(c) + (f' / CAST({THOUSAND} AS DOUBLE)' if c in IN_THOUSANDS else ''), c) for c in FACTOR_NAMES)} FROM panel
""")
def k01_winsorise(t):
    """K-01: per-date winsorisation of every factor at 1-99% (5-95% for Amihud and accruals)."""
    return PR.winsorise(factor_panel(t), FACTOR_NAMES).select("permno", "date", *[
        (F.col(c) / THOUSAND).alias(c) if c in IN_THOUSANDS else F.col(c) for c in FACTOR_NAMES])


@query("k03_sector_zscores", f"""
{oracle_with(*ALL_TABLES, 'sector')},
{ctes(PANEL_PAIRS)}
SELECT panel.permno, panel.date, s.sector, {', '.join(r6(_z_sql(c, 'panel.date, s.sector'), c + '_sz') for c in FACTOR_NAMES)}
FROM panel JOIN sector s ON panel.permno = s.permno
""")
def k03_sector_zscores(t):
    """K-03: every factor z-scored within date and sector (sector neutral)."""
    df = factor_panel(t).join(t["sector"], "permno")
    return PR.zscore(df, FACTOR_NAMES, by=["date", "sector"], suffix="_sz", noise=ENGINE_NOISE).select(
        "permno", "date", "sector", *[c + "_sz" for c in FACTOR_NAMES])


@query("k04_log_amihud", f"""
{oracle_with('bars', 'raw_dsi')},
{ctes(pod_risk_pairs(5) + [PF_CTE])}
SELECT permno, date, {r6('CASE WHEN amihud_illiquidity > 0 THEN ln(amihud_illiquidity) END', 'log_amihud')} FROM pf
""")
def k04_log_amihud(t):
    """K-04: log of the Amihud illiquidity factor."""
    return PR.log_amihud(price_factor_frame(t)).select("permno", "date", "log_amihud")


@query("k05_liquidity_filter", f"""
{oracle_with('bars', 'raw_dsi')},
{ctes(pod_risk_pairs(5) + [PF_CTE])}
SELECT permno, date, {_r(['avg_dollar_volume_20d', 'ret_1m'])} FROM pf WHERE avg_dollar_volume_20d >= {FIXTURE_LIQUIDITY_FLOOR}
""")
def k05_liquidity_filter(t):
    """K-05: keep securities above a 20-day average dollar volume floor."""
    return PR.liquidity_filter(price_factor_frame(t), FIXTURE_LIQUIDITY_FLOOR).select("permno", "date", "avg_dollar_volume_20d", "ret_1m")


def day_feeds(t: Tables) -> DS.Feeds:
    """The feeds of the daily run as month-partitioned tables, so that a step reads the folders of its days."""
    def stored(df, name, date_col, dealt=False):
        return lake.read_partitioned(t.spark, lake.write_partitioned(df, t.spark, name, date_col, dealt=dealt))

    events = AN.latest_period(AN.earnings_events(FU.announcements(t["fundq"], t["ccm_link"]), t["ibes_detail"]))
    return DS.Feeds(
        bars=stored(build_bars(t["lineitem"], by_month=True), "feed-bars", "date", dealt=True), market=t["raw_dsi"],
        fund=stored(FU.linked_quarters(t["fundq"], t["ccm_link"]), "feed-fund", "eff"),
        events=stored(events, "feed-events", "earnings_date"),
        flows=stored(IN.daily_insider(t["form4"]), "feed-flows", "date"))


@query("k07_incremental_day", f"""
{PANEL_WITH}
SELECT permno, date, {_r(FACTOR_NAMES)} FROM panel WHERE date = DATE '{INCREMENTAL_DAY}'
""")
def k07_incremental_day(t):
    """K-07: one day's 34 factors from the stored state of the day before and the day's feeds.

    The store starts from history five calendar days earlier and is advanced day by day to the reported one.
    """
    feeds, path = day_feeds(t), scratch_path(t.spark, "day-state")
    last = dt.date.fromisoformat(INCREMENTAL_DAY)
    days = [last - dt.timedelta(days=n) for n in range(INCREMENTAL_STEPS, -1, -1)]
    DS.write_day(DS.initial_state(feeds, days[0]), path, days[0])
    for as_of, day in zip(days, days[1:]):
        DS.run_day(t.spark, path, feeds, as_of, day)
    return DS.read_panel(t.spark, path, last)


@query("e15_rank_top100", f"""
{oracle_with('bars', 'raw_dsi')},
{ctes(pod_risk_pairs(5) + [PF_CTE])},
rnk AS (SELECT permno, date, ret_12m_skip1m, row_number() OVER (PARTITION BY date ORDER BY ret_12m_skip1m DESC, permno) AS rank
  FROM pf WHERE ret_12m_skip1m IS NOT NULL)
SELECT permno, date, {r6('ret_12m_skip1m', 'ret_12m_skip1m')}, rank FROM rnk WHERE rank <= {PR.TOP_N}
""")
def e15_rank_top100(t):
    """E-15/L-10: rank the universe per date by 12-1 momentum, keep the top 100."""
    df = price_factor_frame(t, few=True).select("permno", "date", "ret_12m_skip1m")
    return PR.rank_top(df, "ret_12m_skip1m").withColumn("rank", F.col("rank").cast("bigint"))
