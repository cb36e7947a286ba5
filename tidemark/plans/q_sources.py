"""Sources, projections, merges: A-01..A-08, A-12, B-01..B-03, B-19, C-01..C-07, G-07."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.merge import adjust_prices, merge_cleaner, merge_nine_rule, normalise_dsf, universe_filter
from tidemark.plans.catalog import query
from tidemark.sources import extracts as X
from tidemark.sources.tables import oracle_with

# The date windows our registered extracts use (fixture calendar is 1992-1998).
RANGE_A01 = ("1996-01-01", "1998-12-31")
RANGE_A02 = ("1997-01-01", "1997-12-31")
RANGE_FUND = ("1994-01-01", "1998-12-31")

DSF_N = """dsf_n AS (SELECT permno, date, row_id, abs(prc) AS close, abs(openprc) AS open, askhi AS high, bidlo AS low,
  vol AS volume, ret, retx, shrout * 1000 AS shares_outstanding, cfacpr, cfacshr FROM raw_dsf)"""

M9 = """m9 AS (SELECT d.*, n.ticker, n.company_name, n.shrcd, n.exchange_code, h.hshrcd, h.hexcd,
  dl.dlret AS delist_ret, dl.dlstcd AS delist_code, i.vwretd, i.ewretd
  FROM dsf_n d JOIN raw_dsenames n ON d.permno = n.permno AND d.date >= n.namedt AND d.date <= n.nameendt
  LEFT JOIN raw_dsfhdr h ON d.permno = h.permno
  LEFT JOIN delistings dl ON d.permno = dl.permno AND d.date = dl.date
  LEFT JOIN raw_dsi i ON d.date = i.date)"""

MC = """mc AS (SELECT d.*, n.ticker, n.company_name, n.shrcd, n.exchange_code,
  dl.dlret AS delist_ret, dl.dlstcd AS delist_code, i.vwretd, i.ewretd,
  (1 + coalesce(d.ret, 0)) * (1 + coalesce(dl.dlret, 0)) - 1 AS ret_total, d.close * d.shares_outstanding AS market_cap
  FROM dsf_n d JOIN raw_dsenames n ON d.permno = n.permno AND d.date >= n.namedt AND (n.nameendt IS NULL OR d.date <= n.nameendt)
  LEFT JOIN delistings dl ON d.permno = dl.permno AND d.date = dl.date
  LEFT JOIN raw_dsi i ON d.date = i.date)"""

M9_FLOATS = ["close", "open", "high", "low", "ret", "retx", "cfacpr", "cfacshr", "delist_ret", "vwretd", "ewretd"]
M9_KEYS = ["permno", "date", "row_id", "volume", "shares_outstanding", "ticker", "company_name", "shrcd",
           "exchange_code", "hshrcd", "hexcd", "delist_code"]


def _rsel(keys, floats, src):
    from tidemark.plans.sqlkit import r6
    return f"SELECT {', '.join(list(keys) + [r6(c, c) for c in floats])} FROM {src}"


@query("a01_price_extract", f"""
{oracle_with('raw_dsf', 'raw_dsenames')},
common AS (SELECT * FROM raw_dsenames WHERE shrcd IN {X.COMMON_SHARE_CODES} AND exchange_code IN {X.MAJOR_EXCHANGES}),
traded AS (SELECT * FROM raw_dsf WHERE date BETWEEN DATE '{RANGE_A01[0]}' AND DATE '{RANGE_A01[1]}' AND vol > 0 AND abs(prc) >= {X.MIN_ABS_PRICE})
SELECT date, permno, ticker, company_name, shrcd, exchange_code, vol, shrout,
  {', '.join(f'round({c} + 1.3e-09, 6) AS {c}' for c in ('prc', 'openprc', 'askhi', 'bidlo', 'ret', 'retx', 'cfacpr', 'cfacshr'))}
FROM traded JOIN common USING (permno) WHERE date BETWEEN namedt AND nameendt
""")
def a01_price_extract(t):
    """A-01: daily prices with the name valid on the date, common stock, major exchange, filters."""
    return X.price_extract(t["raw_dsf"], t["raw_dsenames"], *RANGE_A01)


@query("a02_dsf_range", f"""
{oracle_with('raw_dsf')}
SELECT date, permno, round(prc + 1.3e-09, 6) AS prc, round(openprc + 1.3e-09, 6) AS openprc,
  round(askhi + 1.3e-09, 6) AS askhi, round(bidlo + 1.3e-09, 6) AS bidlo, vol, round(ret + 1.3e-09, 6) AS ret, shrout,
  round(cfacpr + 1.3e-09, 6) AS cfacpr, round(cfacshr + 1.3e-09, 6) AS cfacshr
FROM raw_dsf WHERE date BETWEEN DATE '{RANGE_A02[0]}' AND DATE '{RANGE_A02[1]}' AND abs(prc) >= 5 AND vol > 0
""")
def a02_dsf_range(t):
    """A-02: daily stock file by date range, abs(prc) >= 5, vol > 0."""
    return X.dsf_range(t["raw_dsf"], *RANGE_A02)


@query("a03_names", f"""
{oracle_with('raw_dsenames')}
SELECT permno, ticker, company_name, shrcd, exchange_code, namedt, nameendt FROM raw_dsenames
""")
def a03_names(t):
    """A-03: names history, full table."""
    return X.names(t["raw_dsenames"])


@query("a04_fundamentals_long", f"""
{oracle_with('fundq')}
SELECT gvkey, datadate, rdq, fyearq, fqtr, round(revtq + 1.3e-09, 6) AS revtq, round(cogsq + 1.3e-09, 6) AS cogsq,
  round(niq + 1.3e-09, 6) AS niq, round(atq + 1.3e-09, 6) AS atq, round(ceqq + 1.3e-09, 6) AS ceqq,
  round(cheq + 1.3e-09, 6) AS cheq, round(oancfy + 1.3e-09, 6) AS oancfy, round(capxy + 1.3e-09, 6) AS capxy,
  round(cshoq + 1.3e-09, 6) AS cshoq
FROM fundq WHERE datadate >= DATE '{RANGE_FUND[0]}' AND datadate <= DATE '{RANGE_FUND[1]}'
  AND atq IS NOT NULL AND revtq IS NOT NULL AND rdq IS NOT NULL
""")
def a04_fundamentals_long(t):
    """A-04: fundamentals extract, long form (assets, revenue and report date required)."""
    return X.fundamentals(t["fundq"], *RANGE_FUND, require_core=True)


@query("a04_fundamentals_short", f"""
{oracle_with('fundq')}
SELECT gvkey, datadate, rdq, fyearq, fqtr, round(revtq + 1.3e-09, 6) AS revtq, round(cogsq + 1.3e-09, 6) AS cogsq,
  round(niq + 1.3e-09, 6) AS niq, round(atq + 1.3e-09, 6) AS atq, round(ceqq + 1.3e-09, 6) AS ceqq,
  round(cheq + 1.3e-09, 6) AS cheq, round(oancfy + 1.3e-09, 6) AS oancfy, round(capxy + 1.3e-09, 6) AS capxy,
  round(cshoq + 1.3e-09, 6) AS cshoq
FROM fundq WHERE datadate BETWEEN DATE '{RANGE_FUND[0]}' AND DATE '{RANGE_FUND[1]}'
""")
def a04_fundamentals_short(t):
    """A-04: fundamentals extract, short form (date range only)."""
    return X.fundamentals(t["fundq"], *RANGE_FUND, require_core=False)


@query("a05_estimate_summary", f"""
{oracle_with('ibes_detail')},
s AS (SELECT permno, CAST(last_day(estdate) AS DATE) AS statpers, fpedats,
  CAST(greatest(1, CAST(ceil(datediff('day', CAST(last_day(estdate) AS DATE), fpedats) / 91.0) AS INTEGER)) AS INTEGER) AS fpi,
  count(est) AS numest, avg(est) AS meanest, quantile_cont(est, 0.5) AS medest, stddev_samp(est) AS stdev,
  max(est) AS highest, min(est) AS lowest
  FROM ibes_detail GROUP BY permno, CAST(last_day(estdate) AS DATE), fpedats)
SELECT permno, statpers, fpedats, fpi, numest, round(meanest + 1.3e-09, 6) AS meanest, round(medest + 1.3e-09, 6) AS medest,
  round(stdev + 1.3e-09, 6) AS stdev, round(highest + 1.3e-09, 6) AS highest, round(lowest + 1.3e-09, 6) AS lowest
FROM s WHERE statpers BETWEEN DATE '{RANGE_FUND[0]}' AND DATE '{RANGE_FUND[1]}' AND fpi IN (1, 2, 3, 4) AND numest > 0
""")
def a05_estimate_summary(t):
    """A-05 + D-06: consensus summary built from detail estimates, fpi 1-4, numest > 0."""
    return X.estimate_summary(t["ibes_detail"], *RANGE_FUND)


@query("a06_actuals", f"""
{oracle_with('fundq', 'ccm_link')}
SELECT l.lpermno AS permno, f.rdq AS anndats, f.datadate AS fpedats, round(f.epspxq + 1.3e-09, 6) AS actual
FROM fundq f JOIN ccm_link l ON f.gvkey = l.gvkey AND f.datadate >= l.linkdt AND (l.linkenddt IS NULL OR f.datadate <= l.linkenddt)
WHERE f.rdq BETWEEN DATE '{RANGE_FUND[0]}' AND DATE '{RANGE_FUND[1]}'
""")
def a06_actuals(t):
    """A-06: actual EPS by announcement date (report date of the linked quarter)."""
    return X.actuals(t["fundq"], t["ccm_link"], *RANGE_FUND)


@query("a07_link_table", f"""
{oracle_with('ccm_link')}
SELECT gvkey, lpermno, linkdt, linkenddt FROM ccm_link
""")
def a07_link_table(t):
    """A-07: company-security link table."""
    return t["ccm_link"].select("gvkey", "lpermno", "linkdt", "linkenddt")


@query("a08_parameterised_sql", f"""
{oracle_with('raw_dsf')}
SELECT date, permno, round(prc + 1.3e-09, 6) AS prc, vol, round(ret + 1.3e-09, 6) AS ret, shrout
FROM raw_dsf WHERE date BETWEEN DATE '{RANGE_A02[0]}' AND DATE '{RANGE_A02[1]}' AND abs(prc) >= 5 AND vol > 0
""")
def a08_parameterised_sql(t):
    """A-08: SQL text with named date parameters, bound by the engine (no string formatting)."""
    return X.parameterised_sql(t.spark, X.DSF_RANGE_SQL, X.DateRange.of(*RANGE_A02), raw_dsf=t["raw_dsf"])


@query("a12_partitioned_scan", f"""
{oracle_with('bars')}
SELECT permno, date, round(close + 1.3e-09, 6) AS close, volume, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month
FROM bars WHERE year(date) = 1997 AND month(date) IN (3, 4)
""")
def a12_partitioned_scan(t):
    """A-11/A-12: write bars Hive-partitioned by year/month, read back with partition pruning."""
    from tidemark.sources import lake

    path = lake.write_partitioned(t["bars"].select("permno", "date", "close", "volume"), t.spark, "bars")
    return lake.read_partitioned(t.spark, path).filter((F.col("year") == 1997) & F.col("month").isin(3, 4))


@query("b01_normalise", f"""
{oracle_with('raw_dsf')}, {DSF_N}
{_rsel(['permno', 'date', 'row_id', 'volume', 'shares_outstanding'], ['close', 'open', 'high', 'low', 'ret', 'retx', 'cfacpr', 'cfacshr'], 'dsf_n')}
""")
def b01_normalise(t):
    """B-01..B-03: rename, abs of close/open, shares in thousands to units."""
    return normalise_dsf(t["raw_dsf"])


@query("b19_adjusted_prices", f"""
{oracle_with('raw_dsf')}
SELECT permno, date, row_id, round(CASE WHEN cfacpr <> 0 THEN abs(prc) / cfacpr END + 1.3e-09, 6) AS adj_close,
  round(CASE WHEN cfacpr <> 0 THEN abs(openprc) / cfacpr END + 1.3e-09, 6) AS adj_open,
  round(CASE WHEN cfacpr <> 0 THEN askhi / cfacpr END + 1.3e-09, 6) AS adj_high,
  round(CASE WHEN cfacpr <> 0 THEN bidlo / cfacpr END + 1.3e-09, 6) AS adj_low,
  round(vol * cfacshr + 1.3e-09, 6) AS adj_volume, round(shrout * cfacshr * 1000 + 1.3e-09, 6) AS adj_shares
FROM raw_dsf
""")
def b19_adjusted_prices(t):
    """B-19: split/dividend adjustment of price, volume and shares."""
    return adjust_prices(t["raw_dsf"]).select("permno", "date", "row_id", "adj_close", "adj_open", "adj_high",
                                              "adj_low", "adj_volume", "adj_shares")


@query("c01_merge_nine_rule", f"""
{oracle_with('raw_dsf', 'raw_dsenames', 'raw_dsfhdr', 'delistings', 'raw_dsi')}, {DSF_N}, {M9}
{_rsel(M9_KEYS, M9_FLOATS, 'm9')}
""")
def c01_merge_nine_rule(t):
    """C-01..C-04: names (closed interval), header, delistings and index joined to the daily file."""
    return merge_nine_rule(t.dict("raw_dsf", "raw_dsenames", "raw_dsfhdr", "delistings", "raw_dsi"))


@query("c01_merge_cleaner", f"""
{oracle_with('raw_dsf', 'raw_dsenames', 'delistings', 'raw_dsi')}, {DSF_N}, {MC}
{_rsel([k for k in M9_KEYS if k not in ('hshrcd', 'hexcd')], M9_FLOATS + ['ret_total', 'market_cap'], 'mc')}
""")
def c01_merge_cleaner(t):
    """C-01 (open-ended names), C-03, C-04, B-06, B-07: the cleaner's merge."""
    return merge_cleaner(t.dict("raw_dsf", "raw_dsenames", "raw_dsi", "delistings"))


@query("c06_sql_interval_join", f"""
{oracle_with('raw_dsf', 'raw_dsenames')}
SELECT a.permno, a.date, a.row_id, b.ticker, b.shrcd FROM raw_dsf a
LEFT JOIN raw_dsenames b ON a.permno = b.permno AND b.namedt <= a.date AND a.date <= b.nameendt
""")
def c06_sql_interval_join(t):
    """C-06: the interval join written as SQL text over DataFrame parameters."""
    return t.spark.sql(
        "SELECT a.permno, a.date, a.row_id, b.ticker, b.shrcd FROM {a} a LEFT JOIN {b} b "
        "ON a.permno = b.permno AND b.namedt <= a.date AND a.date <= b.nameendt",
        a=t["raw_dsf"], b=t["raw_dsenames"])


@query("c07_link_fundamentals", f"""
{oracle_with('fundq', 'ccm_link')}
SELECT f.gvkey, l.lpermno AS permno, f.datadate, round(f.revtq + 1.3e-09, 6) AS revtq
FROM fundq f JOIN ccm_link l ON f.gvkey = l.gvkey AND f.datadate >= l.linkdt AND (l.linkenddt IS NULL OR f.datadate <= l.linkenddt)
""")
def c07_link_fundamentals(t):
    """C-07: gvkey to permno within [linkdt, linkenddt], NULL end open."""
    from tidemark.operators.joins import link_to_permno

    return link_to_permno(t["fundq"], t["ccm_link"], "datadate").select("gvkey", "permno", "datadate", "revtq")


@query("g07_universe_nine_rule", f"""
{oracle_with('raw_dsf', 'raw_dsenames', 'raw_dsfhdr', 'delistings', 'raw_dsi')}, {DSF_N}, {M9},
u AS (SELECT * REPLACE (CASE WHEN delist_ret IS NULL AND delist_code BETWEEN 400 AND 591 THEN -0.30 ELSE delist_ret END AS delist_ret)
  FROM m9 WHERE shrcd IN (10, 11) AND exchange_code IN (1, 2, 3) AND close >= 5 AND close * shares_outstanding >= 60000000)
{_rsel(M9_KEYS, M9_FLOATS, 'u')}
""")
def g07_universe_nine_rule(t):
    """G-07 (B-10..B-12): codes, thresholds only when configured, Shumway delisting return."""
    m = merge_nine_rule(t.dict("raw_dsf", "raw_dsenames", "raw_dsfhdr", "delistings", "raw_dsi"))
    return universe_filter(m, min_price=5.0, min_dollar_volume=60_000_000)
