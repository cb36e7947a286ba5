"""Quarterly fundamentals to daily point-in-time columns (E-10..E-12, C-07..C-09, I-01..I-17).

Quarterly work is per company over fiscal quarters (a handful of rows a year).
The daily attachment is an as-of join on the effective date
``coalesce(rdq, datadate + 90)`` with a 390-day forward-fill limit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.semantics import full
from tidemark.operators.joins import asof_join, link_to_permno

# Point-in-time rules.
REPORT_LAG_DAYS = 90
FFILL_MAX_DAYS = 390

FUND_VALUES = ["book_equity", "EPS_ttm", "EBITDA_ttm", "net_debt", "operating_cashflow", "capex", "CFI_ttm",
               "net_income_ttm", "revenue_ttm", "COGS_ttm", "total_assets", "total_debt", "revenue_q",
               "revenue_q_4ago", "EPS_q", "EPS_q_4ago", "shares_outstanding_q"]


def ytd_to_quarterly(df: DataFrame, ytd: str, out: str) -> DataFrame:
    """E-12: quarterly flow from a year-to-date flow; first quarter as is; NULL if the
    previous quarter of the same fiscal year is missing."""
    w = Window.partitionBy("gvkey", "fyearq").orderBy("fqtr")
    prev_v, prev_q = F.lag(ytd).over(w), F.lag("fqtr").over(w)
    return df.withColumn(out, F.when(F.col("fqtr") == 1, F.col(ytd))
                         .when(prev_q == F.col("fqtr") - 1, F.col(ytd) - prev_v))


def same_quarter_last_year(df: DataFrame, cols: list[str], suffix: str = "_4ago") -> DataFrame:
    """E-11: self join on (gvkey, fyearq - 1, fqtr): exact across gaps, unlike lag(4)."""
    prev = df.select("gvkey", (F.col("fyearq") + 1).alias("fyearq"), "fqtr",
                     *[F.col(c).alias(c + suffix) for c in cols])
    return df.join(prev, ["gvkey", "fyearq", "fqtr"], "left")


def quarterly_columns(fundq: DataFrame) -> DataFrame:
    """I-01..I-17 per (gvkey, datadate), plus the effective date ``eff``."""
    q = fundq
    for y, o in (("oancfy", "_cfo_q"), ("capxy", "_capx_q"), ("ivncfy", "_cfi_q")):
        q = ytd_to_quarterly(q, y, o)
    q = same_quarter_last_year(q, ["revtq", "epspxq"])
    w = Window.partitionBy("gvkey").orderBy("datadate")
    ttm = lambda c: full(F.sum, c, w, 4)  # noqa: E731  E-10
    return q.select(
        "gvkey", "datadate", "rdq", "fyearq", "fqtr",
        F.coalesce(F.col("rdq"), F.date_add("datadate", REPORT_LAG_DAYS)).alias("eff"),
        F.col("ceqq").alias("book_equity"),
        ttm("epspxq").alias("EPS_ttm"),
        ttm("oibdpq").alias("EBITDA_ttm"),
        (F.col("dlttq") + F.col("dlcq") - F.col("cheq")).alias("net_debt"),
        ttm("_cfo_q").alias("operating_cashflow"),
        ttm("_capx_q").alias("capex"),
        ttm("_cfi_q").alias("CFI_ttm"),
        ttm("niq").alias("net_income_ttm"),
        ttm("revtq").alias("revenue_ttm"),
        ttm("cogsq").alias("COGS_ttm"),
        F.col("atq").alias("total_assets"),
        (F.col("dlttq") + F.col("dlcq")).alias("total_debt"),
        F.col("revtq").alias("revenue_q"),
        F.col("revtq_4ago").alias("revenue_q_4ago"),
        F.col("epspxq").alias("EPS_q"),
        F.col("epspxq_4ago").alias("EPS_q_4ago"),
        F.col("cshoq").alias("shares_outstanding_q"),
    )


def linked_quarters(fundq: DataFrame, link: DataFrame) -> DataFrame:
    """Quarterly columns per security, one row per (permno, eff): the latest datadate wins
    (a partial aggregate, so restatement bursts combine map-side)."""
    q = link_to_permno(quarterly_columns(fundq), link, "datadate")
    best = F.max_by(F.struct(*[F.col(c) for c in FUND_VALUES + ["datadate"]]), F.col("datadate"))
    return q.groupBy("permno", "eff").agg(best.alias("_q")).select("permno", "eff", "_q.*")


def daily_fundamentals(panel: DataFrame, fundq: DataFrame, link: DataFrame,
                       max_age_days: int = FFILL_MAX_DAYS) -> DataFrame:
    """C-08/C-09: newest quarter whose eff <= date, ties to the latest datadate, NULL past 390 days."""
    q = link_to_permno(quarterly_columns(fundq), link, "datadate")
    return asof_join(panel, q, "permno", "date", "eff", FUND_VALUES + ["datadate"], tie_cols=["datadate"],
                     max_age_days=max_age_days)


def announcements(fundq: DataFrame, link: DataFrame) -> DataFrame:
    """Announced quarterly EPS per security (actuals), one row per report date."""
    f = fundq.filter(F.col("rdq").isNotNull())
    return link_to_permno(f, link, "datadate").select(
        "permno", F.col("rdq").alias("anndats"), F.col("datadate").alias("fpedats"), F.col("epspxq").alias("actual"))
