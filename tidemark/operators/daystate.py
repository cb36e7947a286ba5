"""K-07: a new day's 34 factors from stored per-security state, without reading history.

The store is one Parquet folder per day, ``as_of=YYYY-MM-DD``, with one row per security: a ring of its
last 252 trading rows (what other columns follow from is kept, not they: returns come from the closes), its last 20
dollar volumes and 60 drawdowns, the numerators and denominators of its EWMs, its newest fundamentals and analyst
event, its insider flows of the last 90 days and, where it traded that day, the day's factors. A step reads the
folder before the day and the feeds between the two, so its cost is the universe times the ring, whatever the
length of history. A folder is written in buckets of the security and registered as a table, so a step moves the
day's feeds to the buckets and no ring; where the table is not known (another session), the folder is read and moved.
Everything else is array expressions on one row. A step overwrites its own folder only, so a repeated or retried day
gives the same rows, and later folders are never read for it.

Defined cases: a security that did not trade on a day keeps ring and EWMs (both count rows, not days); one that
appears first on the day starts with an empty ring; one known by facts only has state and no factor row; a NULL price
is a row with NULL values. Feeds hold at most one row per security and date (``bars``, ``flows``); facts that
take effect on one day are ordered by ``datadate`` or ``fpedats``. A fact dated on or before the store's day arrives too
late for a step: rebuild the store from ``initial_state``. NaN prices are not supported here (the cleaner
drops them).
"""

from __future__ import annotations

import datetime as dt
import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.semantics import clip_lower, clip_upper, ewm_alpha, ratio, safe_ln
from tidemark.operators.factors import FACTOR_NAMES, fundamental_factor_columns, price_factor_columns
from tidemark.operators.fundamentals import FFILL_MAX_DAYS, FUND_VALUES
from tidemark.operators.insiders import TRAILING_DAYS
from tidemark.operators.pod import recent_pod, with_market
from tidemark.operators.series import POD_HALO_ROWS

RING_ROWS = 252
RING_FIELDS = ["close", "high", "r_market"]
DV_ROWS, DRAWDOWN_ROWS = 20, 60
EVENT_VALUES = ["earnings_surprise", "earnings_revision_30d", "analyst_dispersion"]
# The EWMs carried, by input and span.
EWMS = {"gain_14": ("rsi_gain", 14), "loss_14": ("rsi_loss", 14), "close_12": ("close", 12), "close_26": ("close", 26),
        "macd_9": ("MACD", 9)}
ARRAYS = ["ring", "dvs", "drawdowns", "flows"]
STATE = ["ring", "dvs", "drawdowns", *[f"ewm_{e}" for e in EWMS], "fund", "event", "flows"]


@dataclass
class Feeds:
    """What a step reads. Each frame is filtered to the days of the step; month-partitioned ones are pruned."""

    bars: DataFrame      # permno, date, open, high, low, close, volume, shares_outstanding
    market: DataFrame    # date, vwretd
    fund: DataFrame      # permno, eff, datadate, FUND_VALUES
    events: DataFrame    # permno, earnings_date, fpedats, EVENT_VALUES
    flows: DataFrame     # permno, date, bought, sold


def days_between(df: DataFrame, date_col: str, after: dt.date | None, upto: dt.date) -> DataFrame:
    """Rows with ``after`` < date <= ``upto``; ``year``/``month`` partition columns, if any, prune the folders."""
    keep = F.col(date_col) <= F.lit(upto)
    if after is not None:
        keep = keep & (F.col(date_col) > F.lit(after))
    if {"year", "month"} <= set(df.columns):
        month = F.col("year") * 12 + F.col("month")
        keep = keep & (month <= upto.year * 12 + upto.month)
        if after is not None:
            keep = keep & (month >= after.year * 12 + after.month)
    return df.filter(keep)


# ---- arrays ----------------------------------------------------------------------------------------

def tail(values: Column, n: int) -> Column:
    """The last ``n`` elements (all, if fewer)."""
    return F.slice(values, F.greatest(F.size(values) - n + 1, F.lit(1)), n)


def mean_of(values: Column, n: int) -> Column:
    """Mean of the last ``n`` values; NULL unless all are there."""
    full = F.array_compact(tail(values, n))
    total = F.aggregate(full, F.lit(0.0), lambda a, x: a + x)
    return F.when(F.size(full) == n, total / n)


def std_of(values: Column, n: int) -> Column:
    """Sample std of the last ``n`` values in one stable pass (running mean and squared distances)."""
    full = F.array_compact(tail(values, n))

    def step(a, x):
        d, k = x - a["mean"], a["n"] + 1.0
        mean = a["mean"] + d / k
        return F.struct(k.alias("n"), mean.alias("mean"), (a["m2"] + d * (x - mean)).alias("m2"))

    start = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    return F.when(F.size(full) == n, F.aggregate(full, start, step, lambda a: F.sqrt(a["m2"] / (n - 1))))


def extreme_of(values: Column, n: int, agg) -> Column:
    full = F.array_compact(tail(values, n))
    return F.when(F.size(full) == n, agg(full))


def quantile_of(values: Column, n: int, p: float) -> Column:
    """Linear-interpolated quantile of the last ``n`` values; NULL unless all are there."""
    full = F.sort_array(F.array_compact(tail(values, n)))
    lo = int(p * (n - 1))
    a, b = F.try_element_at(full, F.lit(lo + 1)), F.try_element_at(full, F.lit(min(lo + 2, n)))
    return F.when(F.size(full) == n, a + (p * (n - 1) - lo) * (b - a))


def returns_of(ring: Column) -> Column:
    """Log return of each row of the ring on the row before it; NULL in the first."""
    return F.transform(ring, lambda e, i: safe_ln(ratio(e["close"], F.get(ring, i - 1)["close"])))


def moments_of(r: Column, r_market: Column, n: int) -> Column:
    """Means, squared distances and co-distance of (r_market, r) over the last ``n`` rows with both, one stable pass."""
    rows = F.zip_with(tail(r, n), tail(r_market, n), lambda x, m: F.struct(x.alias("r"), m.alias("r_market")))
    pairs = F.filter(rows, lambda e: e["r"].isNotNull() & e["r_market"].isNotNull())

    def step(a, e):
        k = a["n"] + 1.0
        dx, dy = e["r_market"] - a["mx"], e["r"] - a["my"]
        mx, my = a["mx"] + dx / k, a["my"] + dy / k
        return F.struct(k.alias("n"), mx.alias("mx"), my.alias("my"), (a["xx"] + dx * (e["r_market"] - mx)).alias("xx"),
                        (a["yy"] + dy * (e["r"] - my)).alias("yy"), (a["xy"] + dx * (e["r"] - my)).alias("xy"))

    start = F.struct(*[F.lit(0.0).alias(c) for c in ("n", "mx", "my", "xx", "yy", "xy")])
    return F.aggregate(pairs, start, step)


def ewm_step(state: Column, x: Column, span: int) -> Column:
    """One row more of an adjusted EWM: both sums decay, a NULL adds nothing to either."""
    q = 1.0 - ewm_alpha(span)
    old = {c: F.coalesce(state[c], F.lit(0.0)) for c in ("num", "den")}
    return F.struct((q * old["num"] + F.coalesce(x, F.lit(0.0))).alias("num"),
                    (q * old["den"] + F.when(x.isNotNull(), 1.0).otherwise(0.0)).alias("den"))


def ewm_value(state: Column) -> Column:
    return F.try_divide(state["num"], state["den"])


# ---- state from history ----------------------------------------------------------------------------

def latest_facts(feeds: Feeds, after: dt.date | None, upto: dt.date) -> DataFrame:
    """Newest fundamentals, newest event and the insider flows of the days, one row per security."""
    fund = days_between(feeds.fund, "eff", after, upto).groupBy("permno").agg(
        F.max_by(F.struct("eff", *FUND_VALUES), F.struct("eff", "datadate")).alias("fund"))
    event = days_between(feeds.events, "earnings_date", after, upto).groupBy("permno").agg(
        F.max_by(F.struct("earnings_date", *EVENT_VALUES), F.struct("earnings_date", "fpedats")).alias("event"))
    flows = days_between(feeds.flows, "date", after, upto).groupBy("permno").agg(
        F.collect_list(F.struct("date", "bought", "sold")).alias("flows"))
    return fund.unionByName(event, allowMissingColumns=True).unionByName(flows, allowMissingColumns=True)


def one_row_each(parts: DataFrame, cols: list[str]) -> DataFrame:
    """Parts of which at most one per security fills a column, as one row per security."""
    return parts.groupBy("permno").agg(*[F.first(c, ignorenulls=True).alias(c) for c in cols])


def initial_state(feeds: Feeds, as_of: dt.date) -> DataFrame:
    """The state of ``as_of`` from history, for a new store: each security's last 650 rows, 390 days of facts."""
    newest = Window.partitionBy("permno").orderBy(F.col("date").desc())
    recent = (days_between(feeds.bars, "date", None, as_of).withColumn("_age", F.row_number().over(newest) - 1)
              .filter(F.col("_age") < POD_HALO_ROWS))
    rows = recent_pod(recent, upto=3, market=feeds.market).withColumn("drawdown", ratio("close", "high_60") - 1)

    def last_rows(n, fields):
        return F.sort_array(F.collect_list(F.when(F.col("_age") < n, F.struct((-F.col("_age")).alias("_o"), *fields))))

    sums = {}
    for name, (x, span) in EWMS.items():
        weight = F.pow(F.lit(1.0 - ewm_alpha(span)), F.col("_age"))
        num = F.coalesce(F.sum(weight * F.col(x)), F.lit(0.0))
        den = F.coalesce(F.sum(F.when(F.col(x).isNotNull(), weight)), F.lit(0.0))
        sums[f"ewm_{name}"] = F.struct(num.alias("num"), den.alias("den"))
    prices = rows.groupBy("permno").agg(
        last_rows(RING_ROWS, RING_FIELDS).alias("_ring"), last_rows(DV_ROWS, ["dv"]).alias("_dvs"),
        last_rows(DRAWDOWN_ROWS, ["drawdown"]).alias("_drawdowns"), *[c.alias(n) for n, c in sums.items()])
    prices = prices.select(
        "permno", F.transform("_ring", lambda e: F.struct(*[e[f].cast("double").alias(f) for f in RING_FIELDS])).alias("ring"),
        F.col("_dvs")["dv"].alias("dvs"), F.col("_drawdowns")["drawdown"].alias("drawdowns"), *sums)
    facts = latest_facts(feeds, as_of - dt.timedelta(days=FFILL_MAX_DAYS + 1), as_of)
    return with_live_flows(beside(prices, one_row_each(facts, ["fund", "event", "flows"])).select("permno", *STATE), as_of)


def keyed(df: DataFrame) -> DataFrame:
    """With ``_key``, the security as text: the NULL security is one too and meets itself in a join."""
    return df if "_key" in df.columns else df.withColumn("_key", F.coalesce(F.col("permno").cast("string"), F.lit("")))


def beside(state: DataFrame, new: DataFrame) -> DataFrame:
    """Both frames' columns, one row for each security of either; each has at most one row per security."""
    right = keyed(new).withColumnsRenamed({"permno": "_permno"})
    return (keyed(state).join(right, "_key", "full_outer").withColumn("permno", F.coalesce("permno", "_permno"))
            .drop("_permno"))


def with_live_flows(state: DataFrame, day: dt.date) -> DataFrame:
    live = F.filter("flows", lambda x: x["date"] > F.lit(day - dt.timedelta(days=TRAILING_DAYS)))
    return state.withColumn("flows", F.coalesce(live, F.array().cast(state.schema["flows"].dataType)))


# ---- one day ---------------------------------------------------------------------------------------

def advance(state: DataFrame, feeds: Feeds, as_of: dt.date, day: dt.date) -> DataFrame:
    """State of ``day`` from that of ``as_of`` and the feeds of (as_of, day]; ``factors`` is NULL without a bar."""
    if day <= as_of:
        raise ValueError(f"the state is of {as_of}: a step leads to a later day, not to {day}")
    yesterday = day - dt.timedelta(days=1)
    bars = with_market(days_between(feeds.bars, "date", yesterday, day), days_between(feeds.market, "date", yesterday, day))
    bar = bars.select("permno", F.struct("open", "high", "low", "close", "volume", "shares_outstanding", "r_market").alias("bar"))
    new = latest_facts(feeds, as_of, day).withColumnsRenamed({"fund": "_fund", "event": "_event", "flows": "_flows"})
    new = one_row_each(bar.unionByName(new, allowMissingColumns=True), ["bar", "_fund", "_event", "_flows"])
    df = beside(keyed(state).select("_key", "permno", *STATE), new)
    empty = {c: F.array().cast(state.schema[c].dataType) for c in ARRAYS}
    df = df.withColumns({
        "fund": F.coalesce("_fund", "fund"), "event": F.coalesce("_event", "event"),
        **{c: F.coalesce(c, empty[c]) for c in ("ring", "dvs", "drawdowns")},
        "flows": F.concat(F.coalesce("flows", empty["flows"]), F.coalesce("_flows", empty["flows"])),
        "_traded": F.col("bar").isNotNull(),
    }).drop("_fund", "_event", "_flows")
    df = with_live_flows(df, day).select("*", "bar.*")
    return with_factors(with_day_row(df), day).select("_key", "permno", *STATE, "factors")


def with_day_row(df: DataFrame) -> DataFrame:
    """The day's own columns, EWMs moved on, the arrays with the day and the ring (``_ring``: 252 rows before the day, then
    the day)."""
    traded = F.col("_traded")

    def before(n):
        return F.try_element_at(F.col("ring"), F.lit(-n))["close"]

    df = df.withColumns({f"P_{n}": before(n) for n in (1, 21, 126, 252)})
    df = df.withColumns({"r": safe_ln(ratio("close", "P_1")), "r_1d": ratio("close", "P_1") - 1,
                         "dv": F.col("close") * F.col("volume"), "hl": F.col("high") - F.col("low"),
                         "market_cap": F.col("close") * F.col("shares_outstanding")})
    highs = F.concat(F.col("ring")["high"], F.array("high"))
    df = df.withColumns({"rsi_gain": clip_lower("r_1d", 0.0), "rsi_loss": clip_lower(-F.col("r_1d"), 0.0),
                         "high_252": extreme_of(highs, 252, F.array_max),
                         "drawdown": ratio("close", extreme_of(highs, 60, F.array_max)) - 1})

    def moved(name):
        x, span = EWMS[name]
        old = F.col(f"ewm_{name}")
        return F.when(traded, ewm_step(old, F.col(x), span)).otherwise(old)

    df = df.withColumns({f"ewm_{n}": moved(n) for n in EWMS if n != "macd_9"})
    df = df.withColumn("MACD", ewm_value(F.col("ewm_close_12")) - ewm_value(F.col("ewm_close_26")))
    df = df.withColumn("ewm_macd_9", moved("macd_9"))
    row = F.array(F.struct(*[F.col(f).cast("double").alias(f) for f in RING_FIELDS]))

    def appended(name, new):
        return F.when(traded, F.concat(name, new)).otherwise(F.col(name))

    df = df.withColumns({"_ring": appended("ring", row), **{
        f"{c}s": tail(appended(f"{c}s", F.array(F.col(c).cast("double"))), n) for c, n in (("dv", DV_ROWS), ("drawdown", DRAWDOWN_ROWS))}})
    return df.withColumn("ring", tail(F.col("_ring"), RING_ROWS))


def with_factors(df: DataFrame, day: dt.date) -> DataFrame:
    """The 34 factors of the securities that traded on ``day`` as one struct, by the expressions of the panel."""
    close, r = F.col("_ring")["close"], F.col("_r")
    sd_close, mean_close = std_of(close, 20), mean_of(close, 20)
    amihud = F.zip_with(tail(r, DV_ROWS), F.col("dvs"), lambda x, dv: ratio(F.abs(x), dv))
    df = df.withColumn("_r", returns_of(F.col("_ring"))).withColumns({
        "SMA_20": mean_close, "SMA_50": mean_of(close, 50), "SMA_200": mean_of(close, 200), "std_P_20": sd_close,
        "std_r_20": std_of(r, 20), "std_r_60": std_of(r, 60),
        "std_r_down_20": std_of(F.transform(r, lambda x: clip_upper(x, 0.0)), 20),
        "dv_20": mean_of(F.col("dvs"), 20), "amihud_20": mean_of(amihud, 20),
        "avg_gain_14": ewm_value(F.col("ewm_gain_14")), "avg_loss_14": ewm_value(F.col("ewm_loss_14")),
        "MACD_hist": F.col("MACD") - ewm_value(F.col("ewm_macd_9")), "log_market_cap": safe_ln("market_cap"),
        "VaR_95": quantile_of(r, 252, 0.05), "max_drawdown_60d": extreme_of(F.col("drawdowns"), 60, F.array_min),
        "_m": moments_of(r, F.col("_ring")["r_market"], 252),
    })
    whole = F.col("_m.n") == 252
    df = df.withColumns({"BB_width": ratio((F.col("SMA_20") + 2 * F.col("std_P_20")) - (F.col("SMA_20") - 2 * F.col("std_P_20")), "SMA_20"),
                         "beta_1y": F.when(whole, F.try_divide("_m.xy", "_m.xx"))})
    left = (F.col("_m.yy") - F.col("beta_1y") * F.col("beta_1y") * F.col("_m.xx")) / 251
    df = df.withColumn("idiosyncratic_vol", F.when(whole, F.sqrt(F.greatest(left, F.lit(0.0)))))
    for name, dated, values in (("fund", "eff", FUND_VALUES), ("event", "earnings_date", EVENT_VALUES)):
        fresh = F.datediff(F.lit(day), F.col(name)[dated]) <= FFILL_MAX_DAYS
        df = df.withColumns({v: F.when(fresh, F.col(name)[v]) for v in values})

    def flow(kind):
        return F.aggregate("flows", F.lit(0.0), lambda a, x: a + x[kind].cast("double"))

    df = df.withColumns(price_factor_columns() | fundamental_factor_columns()
                        | {"insider_buy_sell_ratio": F.when(flow("sold") > 0, F.try_divide(flow("bought"), flow("sold")))})
    return df.withColumn("factors", F.when(F.col("_traded"), F.struct(*FACTOR_NAMES)))


# ---- the store -------------------------------------------------------------------------------------

def folder(path: str, day: dt.date) -> str:
    return f"{path}/as_of={day.isoformat()}"


def table_of(path: str, day: dt.date, buckets: int) -> str:
    return f"day_state_{hashlib.md5(path.encode()).hexdigest()[:12]}_{day:%Y%m%d}_{buckets}"


def write_day(state: DataFrame, path: str, day: dt.date) -> None:
    """The folder of ``day`` in as many buckets as a shuffle has partitions; the rows hold that number (``_buckets``)."""
    n = int(state.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (keyed(state).withColumn("_buckets", F.lit(n)).write.format("parquet").mode("overwrite").bucketBy(n, "_key")
     .option("path", folder(path, day)).saveAsTable(table_of(path, day, n)))


def read_state(spark: SparkSession, path: str, day: dt.date) -> DataFrame:
    """The folder of ``day``, by its buckets if this session knows the table of that many."""
    stored = spark.read.parquet(folder(path, day))
    row = stored.select("_buckets").first() if "_buckets" in stored.columns else None
    table = table_of(path, day, row["_buckets"]) if row else None
    if table is None or not spark.catalog.tableExists(table):
        return stored
    spark.catalog.refreshTable(table)
    return spark.table(table)


def run_day(spark: SparkSession, path: str, feeds: Feeds, as_of: dt.date, day: dt.date) -> None:
    """Read the folder of ``as_of``, write that of ``day``."""
    write_day(advance(read_state(spark, path, as_of), feeds, as_of, day), path, day)


def read_panel(spark: SparkSession, path: str, day: dt.date) -> DataFrame:
    """The factors of ``day``: permno, date and the 34 factors; reads no ring."""
    df = spark.read.parquet(folder(path, day)).filter(F.col("factors").isNotNull())
    return df.select("permno", F.lit(day).alias("date"), "factors.*")
