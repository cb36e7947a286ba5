"""Insider trading columns (E-13, E-14, I-24..I-26, J-35, L-02).

Filings are first collapsed per (permno, day[, filer]) by partial aggregates, so a
hot security-day of filings is combined map-side; calendar frames then run over
day numbers with integer RANGE bounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Open-market transaction codes and windows.
BUY, SELL = "P", "S"
TRAILING_DAYS = 90
CLUSTER_DAYS = 30
CLUSTER_MIN_INSIDERS = 3


def day_number(c: str):
    return F.datediff(F.col(c), F.lit("1970-01-01").cast("date"))


def open_market(form4: DataFrame) -> DataFrame:
    """I-26: purchases and sales only."""
    return form4.filter(F.col("transaction_type").isin(BUY, SELL))


def daily_insider(form4: DataFrame) -> DataFrame:
    """Shares bought and sold per (permno, trade_date)."""
    f = open_market(form4)
    return f.groupBy("permno", F.col("trade_date").alias("date")).agg(
        F.sum(F.when(F.col("transaction_type") == BUY, F.col("shares")).otherwise(F.lit(0.0))).alias("bought"),
        F.sum(F.when(F.col("transaction_type") == SELL, F.col("shares")).otherwise(F.lit(0.0))).alias("sold"),
    )


def trailing_insider(daily: DataFrame, days: int = TRAILING_DAYS) -> DataFrame:
    """E-13, I-24, I-25, J-35 at activity dates: sums over the trailing ``days`` calendar days."""
    w = Window.partitionBy("permno").orderBy(day_number("date")).rangeBetween(-(days - 1), 0)
    b, s = F.sum("bought").over(w), F.sum("sold").over(w)
    return daily.select("permno", "date", b.alias("insider_shares_bought"), s.alias("insider_shares_sold"),
                        F.when(s > 0, F.try_divide(b, s)).alias("insider_buy_sell_ratio"))


def insider_clusters(form4: DataFrame, days: int = CLUSTER_DAYS) -> DataFrame:
    """E-14: distinct insiders buying in the trailing ``days`` days, per buying day.

    A purchase counts for its insider on the ``days`` days from it on. Per insider, overlapping spans
    merge: +1 on the first day of a merged span, -1 on the day after its last. Summed per day and added
    up per security (days are bounded by the calendar), that is the number of insiders, however many file.
    """
    buys = form4.filter(F.col("transaction_type") == BUY).select("permno", "filer", F.col("trade_date").alias("date")).distinct()
    own = Window.partitionBy("permno", "filer").orderBy("date")
    starts = F.coalesce(F.datediff("date", F.lag("date").over(own)) >= days, F.lit(True))
    ends = F.coalesce(F.datediff(F.lead("date").over(own), "date") >= days, F.lit(True))
    spans = buys.select("permno", "date", starts.alias("starts"), ends.alias("ends"))
    steps = spans.select("permno", F.explode(F.array(
        F.struct("date", F.col("starts").cast("long").alias("step"), F.lit(True).alias("buying")),
        F.struct(F.date_add("date", days).alias("date"), (-F.col("ends").cast("long")).alias("step"), F.lit(False).alias("buying")),
    )).alias("x"))
    daily = steps.groupBy("permno", F.col("x.date").alias("date")).agg(
        F.sum("x.step").alias("step"), F.max("x.buying").alias("buying"))
    run = Window.partitionBy("permno").orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (daily.withColumn("cluster_insiders", F.sum("step").over(run)).filter("buying")
            .select("permno", "date", "cluster_insiders"))


def cluster_events(form4: DataFrame, min_insiders: int = CLUSTER_MIN_INSIDERS) -> DataFrame:
    """L-02: days where at least ``min_insiders`` distinct insiders bought within 30 days."""
    return insider_clusters(form4).filter(F.col("cluster_insiders") >= min_insiders)
