"""Extract queries (A-01..A-09) as DataFrame reads with pushed-down filters.

The extracts read Parquet (or a JDBC source with the same columns); Catalyst pushes
the simple predicates to the scan. ``abs(prc) >= 5`` is a function of the column, so
it is evaluated after the scan; ``vol > 0`` and the date bounds are pushed.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Extract filters.
COMMON_SHARE_CODES = (10, 11)
MAJOR_EXCHANGES = (1, 2, 3)
MIN_ABS_PRICE = 5
# Column names of the names history and of the daily stock file.
NAME_COLUMNS = ["ticker", "company_name", "shrcd", "exchange_code"]
PRICE_COLUMNS = ["prc", "openprc", "askhi", "bidlo", "vol", "ret", "shrout", "cfacpr", "cfacshr"]


def _day(x) -> dt.date:
    return dt.date.fromisoformat(x) if isinstance(x, str) else dt.date(x.year, x.month, x.day)


@dataclass(frozen=True)
class DateRange:
    """A-09: an inclusive, non-empty range of days."""

    start: dt.date
    end: dt.date

    @classmethod
    def of(cls, start, end) -> "DateRange":
        """From dates, timestamps or ISO strings; anything else, or an empty range, is a ValueError."""
        try:
            out = cls(_day(start), _day(end))
        except AttributeError:
            raise ValueError(f"not a pair of days: {start!r}, {end!r}") from None
        if out.end < out.start:
            raise ValueError(f"empty date range: {out.start} to {out.end}")
        return out

    def col_between(self, c: str):
        return F.col(c).between(F.lit(self.start), F.lit(self.end))


def traded(raw_dsf: DataFrame, start, end) -> DataFrame:
    """Rows of the range that traded at a price of at least five dollars."""
    return raw_dsf.where(DateRange.of(start, end).col_between("date")).where("vol > 0").where(F.abs("prc") >= MIN_ABS_PRICE)


def price_extract(raw_dsf: DataFrame, names: DataFrame, start, end) -> DataFrame:
    """A-01: traded rows with the name in effect, common stock on a major exchange, by date and security."""
    common = names.where(F.col("shrcd").isin(*COMMON_SHARE_CODES) & F.col("exchange_code").isin(*MAJOR_EXCHANGES))
    named = traded(raw_dsf, start, end).join(common, "permno").where(F.col("date").between(F.col("namedt"), F.col("nameendt")))
    return named.select("date", "permno", *NAME_COLUMNS, *PRICE_COLUMNS, "retx").orderBy("date", "permno")


def dsf_range(raw_dsf: DataFrame, start, end) -> DataFrame:
    """A-02: traded rows of the daily stock file."""
    return traded(raw_dsf, start, end).select("date", "permno", *PRICE_COLUMNS)


def names(raw_dsenames: DataFrame) -> DataFrame:
    """A-03: names history."""
    return raw_dsenames.select("permno", *NAME_COLUMNS, "namedt", "nameendt")


FUND_COLUMNS = ["gvkey", "datadate", "rdq", "fyearq", "fqtr", "revtq", "cogsq", "niq", "atq", "ceqq", "cheq",
                "oancfy", "capxy", "cshoq"]


def fundamentals(fundq: DataFrame, start, end, require_core: bool) -> DataFrame:
    """A-04: quarterly fundamentals by datadate; long form also requires assets, revenue, rdq."""
    r = DateRange.of(start, end)
    df = fundq.filter(r.col_between("datadate"))
    if require_core:
        df = df.filter(F.col("atq").isNotNull() & F.col("revtq").isNotNull() & F.col("rdq").isNotNull())
    return df.select(*FUND_COLUMNS).orderBy("gvkey", "datadate")


def consensus(ibes_detail: DataFrame) -> DataFrame:
    """D-06: consensus per (permno, statpers = month end of estdate, fpedats)."""
    statpers = F.last_day("estdate")
    fpi = F.greatest(F.lit(1), F.ceil(F.datediff("fpedats", "statpers") / F.lit(91.0)).cast("int")).cast("int")
    return ibes_detail.groupBy("permno", statpers.alias("statpers"), "fpedats").agg(
        F.count("est").alias("numest"), F.avg("est").alias("meanest"), F.percentile("est", 0.5).alias("medest"),
        F.stddev_samp("est").alias("stdev"), F.max("est").alias("highest"), F.min("est").alias("lowest"),
    ).withColumn("fpi", fpi)


def estimate_summary(ibes_detail: DataFrame, start, end) -> DataFrame:
    """A-05: summary rows in the range, fpi in 1..4, numest > 0."""
    r = DateRange.of(start, end)
    s = consensus(ibes_detail)
    return s.filter(r.col_between("statpers") & F.col("fpi").isin(1, 2, 3, 4) & (F.col("numest") > 0)).select(
        "permno", "statpers", "fpedats", "fpi", "numest", "meanest", "medest", "stdev", "highest", "lowest")


def actuals(fundq: DataFrame, link: DataFrame, start, end) -> DataFrame:
    """A-06: announced EPS per security by announcement date."""
    from tidemark.operators.joins import link_to_permno

    r = DateRange.of(start, end)
    f = fundq.filter(r.col_between("rdq"))
    return link_to_permno(f, link, "datadate").select(
        "permno", F.col("rdq").alias("anndats"), F.col("datadate").alias("fpedats"), F.col("epspxq").alias("actual"))


# The parameterised extract text (named parameters, bound by Spark).
DSF_RANGE_SQL = ("SELECT date, permno, prc, vol, ret, shrout FROM {raw_dsf} "
                 "WHERE date BETWEEN :start AND :end AND abs(prc) >= 5 AND vol > 0")


def parameterised_sql(spark: SparkSession, text: str, rng: DateRange, **frames: DataFrame) -> DataFrame:
    """A-08: run extract text with ``:start``/``:end`` bound as typed parameters."""
    return spark.sql(text, args={"start": rng.start, "end": rng.end}, **frames)
