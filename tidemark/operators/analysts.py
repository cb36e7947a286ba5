"""Analyst consensus and earnings events (D-06, C-11, C-12, I-18..I-23, J-31..J-33, L-01)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.extracts import consensus

# Analyst rules.
REVISION_DAYS = 30
MIN_ANALYSTS_DISPERSION = 3


def earnings_events(actuals: DataFrame, ibes_detail: DataFrame) -> DataFrame:
    """``events_by_consensus`` over the consensus of the estimates."""
    return events_by_consensus(actuals, consensus(ibes_detail))


def events_by_consensus(actuals: DataFrame, estimates: DataFrame) -> DataFrame:
    """One row per announcement: actual, consensus just before (strict), consensus 30 days
    earlier, analyst count, surprise, revision and dispersion. ``estimates``: ``extracts.consensus`` rows.

    Both consensus lookups are carries over the same union of announcements and consensus rows, with
    RANGE frames that end 1 and 30 days back: one shuffle and one sort.
    """
    def day(c: str):
        return F.datediff(F.col(c), F.lit("1970-01-01").cast("date"))

    cons = estimates.select("permno", "fpedats", day("statpers").alias("_t"),
                                         F.struct("meanest", "numest", "stdev").alias("_cons"))
    w = Window.partitionBy("permno", "fpedats").orderBy("_t")
    newest = F.last("_cons", ignorenulls=True)
    ev = (actuals.select("*", day("anndats").alias("_t"), F.lit(True).alias("_announced"))
          .unionByName(cons, allowMissingColumns=True)
          .withColumns({"_c": newest.over(w.rangeBetween(Window.unboundedPreceding, -1)),
                        "_p": newest.over(w.rangeBetween(Window.unboundedPreceding, -REVISION_DAYS))})
          .filter("_announced"))
    c, p = F.col("_c.meanest"), F.col("_p.meanest")
    return ev.select(
        "permno", F.col("anndats").alias("earnings_date"), "fpedats",
        F.col("actual").alias("EPS_actual"), c.alias("EPS_consensus"), p.alias("EPS_consensus_t_30"),
        F.col("_c.numest").alias("analyst_count"),
        F.try_divide(F.col("actual") - c, F.abs(c)).alias("earnings_surprise"),
        F.try_divide(c - p, F.abs(p)).alias("earnings_revision_30d"),
        F.when(F.col("_c.numest") >= MIN_ANALYSTS_DISPERSION, F.try_divide(F.col("_c.stdev"), F.abs(c)))
        .alias("analyst_dispersion"),
    )


def latest_period(events: DataFrame) -> DataFrame:
    """One event per security and announcement day: that of the latest fiscal period."""
    values = [c for c in events.columns if c not in ("permno", "earnings_date", "fpedats")]
    best = F.max_by(F.struct(*values), "fpedats").alias("_e")
    return events.groupBy("permno", "earnings_date").agg(F.max("fpedats").alias("fpedats"), best).select(
        "permno", "earnings_date", "fpedats", "_e.*")
