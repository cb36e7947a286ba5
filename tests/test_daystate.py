"""The daily run from stored state: equal to the panel from history, pruned reads, repeatable days, edge rows."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions.semantics import ewm_alpha
from tidemark.operators import daystate as DS
from tidemark.operators.factors import FACTOR_NAMES
from tidemark.operators.fundamentals import FUND_VALUES
from tidemark.plans import q_factors as Q
from tidemark.session import scratch_path
from tidemark.sources import lake

DAY = dt.date(2001, 3, 1)
BARS = "permno long, date date, open double, high double, low double, close double, volume long, shares_outstanding long"
FUND = "permno long, eff date, datadate date, " + ", ".join(f"{v} double" for v in FUND_VALUES)
EVENTS = "permno long, earnings_date date, fpedats date, " + ", ".join(f"{v} double" for v in DS.EVENT_VALUES)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def series(permno, days, seed):
    rng, price, out = random.Random(seed), 100.0, []
    for day in days:
        price *= math.exp(rng.gauss(0, 0.02))
        out.append((permno, day, price * 0.99, price * 1.02, price * 0.97, price, rng.randint(1000, 9000), 10_000))
    return out


def feeds_of(spark, bars, flows=(), fund=(), events=()):
    days = sorted({b[1] for b in bars})
    rng = random.Random(9)
    market = [(d, rng.gauss(0, 0.01)) for d in days]
    return DS.Feeds(
        bars=lake.read_partitioned(spark, lake.write_partitioned(spark.createDataFrame(bars, BARS), spark, "t-bars")),
        market=spark.createDataFrame(market, "date date, vwretd double"),
        fund=spark.createDataFrame(list(fund), FUND), events=spark.createDataFrame(list(events), EVENTS),
        flows=spark.createDataFrame(list(flows), "permno long, date date, bought double, sold double"))


def stepped(spark, feeds, start, steps):
    path = scratch_path(spark, "t-state")
    DS.write_day(DS.initial_state(feeds, start), path, start)
    days = [start + dt.timedelta(days=n) for n in range(steps + 1)]
    for as_of, day in zip(days, days[1:]):
        DS.run_day(spark, path, feeds, as_of, day)
    return path, days


@pytest.fixture(scope="module")
def edge(spark):
    """1 trades daily, 2 misses the second day, 3 starts on the third day, 4 is known by facts only, 5 has a NULL price."""
    history = [DAY - dt.timedelta(days=n) for n in range(700, 0, -1)]
    days = [DAY + dt.timedelta(days=n) for n in range(4)]
    bars = series(1, history + days, 1) + series(2, history + [d for d in days if d != days[1]], 2) + series(3, days[2:], 3)
    gap = [list(b) for b in series(5, history + days, 5)]
    gap[-2][2:6] = [None] * 4
    bars += [tuple(b) for b in gap]
    values = [float(i + 1) for i in range(len(FUND_VALUES))]
    fund = [(1, DAY - dt.timedelta(days=389), DAY - dt.timedelta(days=420), *values),
            (4, days[1], DAY, *values), (2, days[2], DAY, *values)]
    flows = [(1, DAY - dt.timedelta(days=88), 5.0, 0.0), (1, days[0], 0.0, 4.0), (1, days[2], 7.0, 0.0)]
    events = [(1, days[1], DAY, 0.25, None, 0.5)]
    feeds = feeds_of(spark, bars, flows, fund, events)
    path, when = stepped(spark, feeds, DAY - dt.timedelta(days=1), 4)
    return feeds, path, when[1:]


def rows_of(spark, path, day):
    return {r["permno"]: r for r in DS.read_panel(spark, path, day).collect()}


def test_equals_the_panel_from_history_on_every_day(spark, tables_small):
    t = tables_small
    feeds = Q.day_feeds(t)
    start = dt.date(1998, 6, 24)
    path, days = stepped(spark, feeds, start, 4)
    panel = Q.factor_panel(t).filter(F.col("date") > F.lit(start)).filter(F.col("date") <= F.lit(days[-1]))
    want = {(r["permno"], r["date"]): r for r in panel.collect()}
    got = {(r["permno"], r["date"]): r for d in days[1:] for r in DS.read_panel(spark, path, d).collect()}
    assert got.keys() == want.keys() and len(want) > 0
    for key, row in want.items():
        for f in FACTOR_NAMES:
            assert (row[f] is None) == (got[key][f] is None), (key, f)
            if row[f] is not None:
                assert got[key][f] == pytest.approx(row[f], rel=1e-7, abs=1e-9), (key, f)


def test_price_factors_of_a_long_series_equal_the_pod(spark, edge):
    feeds, path, days = edge
    pod = Q.price_factors(Q.build_pod(feeds.bars.filter("permno IN (1, 2, 5)"), upto=5, market=feeds.market))
    cols = [f for f in FACTOR_NAMES if f in pod.columns]
    assert len(cols) == 20
    want = {(r["permno"], r["date"]): r for r in pod.filter(F.col("date") >= F.lit(DAY)).collect()}
    for day in days:
        got = rows_of(spark, path, day)
        for p in (1, 2, 5):
            if (p, day) not in want:
                assert p not in got
                continue
            for f in cols:
                expected = want[p, day][f]
                assert got[p][f] == (None if expected is None else pytest.approx(expected, rel=1e-6, abs=1e-10)), (p, day, f)


def test_a_missed_day_moves_nothing(spark, edge):
    _, path, days = edge
    state = [spark.read.parquet(DS.folder(path, d)).filter("permno = 2").first() for d in days[:2]]
    assert state[1]["factors"] is None
    assert state[0]["ring"] == state[1]["ring"] and state[0]["ewm_macd_9"] == state[1]["ewm_macd_9"]


def test_new_securities_and_facts_without_prices(spark, edge):
    _, path, days = edge
    last = rows_of(spark, path, days[2])
    assert set(last) == {1, 2, 3, 5}
    assert last[3]["ret_1m"] is None and last[3]["bid_ask_spread_proxy"] is not None
    state = spark.read.parquet(DS.folder(path, days[3])).filter("permno = 4").first()
    assert state["fund"]["book_equity"] == 1.0 and list(state["ring"]) == []
    # the price is NULL on the third day: a row of NULLs, and the same EWM of closes a weight older
    assert last[5]["ret_1m"] is None
    before, after = (spark.read.parquet(DS.folder(path, d)).filter("permno = 5").first()["ewm_close_12"] for d in days[1:3])
    q = 1.0 - ewm_alpha(12)
    assert after["num"] == pytest.approx(q * before["num"]) and after["den"] == pytest.approx(q * before["den"])


def test_facts_age_and_flows_leave(spark, edge):
    _, path, days = edge
    first, second, third = (rows_of(spark, path, d)[1] for d in days[:3])
    assert first["gross_profitability"] is not None and second["gross_profitability"] is not None  # 389 and 390 days
    assert third["gross_profitability"] is None  # 391 days
    # 88 days back on the first day, 89 on the second, out on the third, where 7 more are bought
    assert [r["insider_buy_sell_ratio"] for r in (first, second, third)] == [5 / 4, 5 / 4, 7 / 4]
    assert first["earnings_surprise"] is None and second["earnings_surprise"] == 0.25 == third["earnings_surprise"]


def test_a_repeated_day_gives_the_same_rows_and_no_day_goes_back(spark, edge):
    feeds, path, days = edge
    before = rows_of(spark, path, days[2])
    DS.run_day(spark, path, feeds, days[1], days[2])
    assert rows_of(spark, path, days[2]) == before
    with pytest.raises(ValueError):
        DS.run_day(spark, path, feeds, days[2], days[2])


def test_a_step_reads_the_days_folders_only(spark, edge):
    feeds, path, days = edge
    physical = plan(DS.advance(spark.read.parquet(DS.folder(path, days[0])), feeds, days[0], days[1]))
    assert "Window" not in physical and "Python" not in physical
    assert "PartitionFilters: [isnotnull(year" in physical
    files = DS.days_between(feeds.bars, "date", days[0], days[1]).select("date").withColumn("f", F.input_file_name())
    assert files.select("f").distinct().count() <= files.select("date").distinct().count()
    assert "ring" not in plan(DS.read_panel(spark, path, days[1])).split("ReadSchema")[1]


def test_empty_feeds(spark):
    feeds = feeds_of(spark, series(1, [DAY - dt.timedelta(days=n) for n in range(5, 0, -1)], 4))
    path, days = stepped(spark, feeds, DAY, 1)
    assert DS.read_panel(spark, path, days[1]).count() == 0
    assert len(spark.read.parquet(DS.folder(path, days[1])).first()["ring"]) == 5
