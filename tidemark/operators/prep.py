"""Cross-sectional preparation (K-01..K-05, K-07) and ranking (E-15, L-10).

Cross-sections are per date: a date holds one row per security after dedupe, so a
date group is bounded by the universe size. Top-k uses ``row_number() <= k`` which
Spark plans as a WindowGroupLimit: each task keeps only its k best rows per date
before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.semantics import clip, safe_ln
from tidemark.session import written

# Winsorisation levels and liquidity floors.
WINSOR_DEFAULT = (0.01, 0.99)
WINSOR_SKEWED = (0.05, 0.95)
SKEWED_FACTORS = ("amihud_illiquidity", "sloan_accruals")
LIQUIDITY_FLOORS = (1_000_000, 10_000_000)
TOP_N = 100
# Fixed value: columns whose exact percentiles are found in one pass.
BOUND_COLUMNS = 9


def winsorise(df: DataFrame, cols: list[str], by: str = "date", store: bool = True) -> DataFrame:
    """K-01: clip each column to its per-date percentile bounds (1-99, 5-95 for skewed).

    Bounds are an aggregate per date (calendar-sized) that is joined back, so the wide rows are
    neither sorted nor moved by date (the bounds are written first, so that the planner knows their
    size); both levels of a column come from one pass. An exact percentile moves every value of its column, so the
    bounds are found for ``BOUND_COLUMNS`` columns at a time, each read alone and its shuffle removed before the next.
    ``store=False``: ``df`` is a cheap read of a written table, not to be written again.
    """
    out = df = written(df, "winsor-input") if store else df
    level = {c: WINSOR_SKEWED if c in SKEWED_FACTORS else WINSOR_DEFAULT for c in cols}
    for lo in range(0, len(cols), BOUND_COLUMNS):
        part = [F.percentile(c, list(level[c])).alias(f"_b_{c}") for c in cols[lo:lo + BOUND_COLUMNS]]
        out = out.join(written(df.groupBy(by).agg(*part), "winsor-bounds"), by, "left")
    return out.withColumns({c: clip(c, F.col(f"_b_{c}")[0], F.col(f"_b_{c}")[1]) for c in cols}).select(df.columns)


def zscore(df: DataFrame, cols: list[str], by: list[str] | None = None, suffix: str = "_z", noise: float = 0.0,
           store: bool = True) -> DataFrame:
    """K-02/K-03: (x - mean) / std within date (and sector when ``by`` includes it).

    Means and stds are partial aggregates per group, written and joined back to the written rows (``store`` as in
    ``winsorise``). A group whose std
    is at most ``noise`` times its |mean| counts as constant (z is NULL); 0 by default: only an exactly
    constant group does.
    """
    by = by or ["date"]
    df = written(df, "zscore-input") if store else df
    stats = written(df.groupBy(*by).agg(*[f(c).alias(f"_{n}_{c}") for c in cols for n, f in (("m", F.avg), ("s", F.stddev_samp))]),
                    "zscore-stats")
    out = {}
    for c in cols:
        mean, std = F.col(f"_m_{c}"), F.col(f"_s_{c}")
        out[c + suffix] = F.when((std > 0) & (std > F.abs(mean) * noise), F.try_divide(F.col(c) - mean, std))
    return df.join(stats, by, "left").withColumns(out).select(*df.columns, *out)


def log_amihud(df: DataFrame, col: str = "amihud_illiquidity", out: str = "log_amihud") -> DataFrame:
    """K-04."""
    return df.withColumn(out, safe_ln(col))


def liquidity_filter(df: DataFrame, floor: float = LIQUIDITY_FLOORS[0], col: str = "avg_dollar_volume_20d") -> DataFrame:
    """K-05."""
    return df.filter(F.col(col) >= floor)


def rank_top(df: DataFrame, score: str, n: int = TOP_N, by: str = "date", tie: str = "permno") -> DataFrame:
    """E-15/L-10: rank 1..N per date by score (desc, NULLs excluded), keep the top N."""
    w = Window.partitionBy(by).orderBy(F.col(score).desc(), F.col(tie))
    return df.filter(F.col(score).isNotNull()).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
