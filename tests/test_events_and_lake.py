"""Events on the next trading row, gap flags between copies, refresh of a lake, shared folders."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark import session
from tidemark.operators import analysts as AN
from tidemark.operators import events as EV
from tidemark.operators import prep as PR
from tidemark.operators.flags import nine_rule_flags
from tidemark.operators.joins import attach_point_in_time
from tidemark.plans import q_models
from tidemark.sources import lake


def d(s):
    return dt.date.fromisoformat(s)


def test_event_falls_on_the_next_trading_row(spark):
    days = [d("2000-01-03") + dt.timedelta(days=7 * i) for i in range(70)]
    bars = spark.createDataFrame([(1, x, 100.0 * 1.01 ** i) for i, x in enumerate(days)], "permno long, date date, close double")
    ev = spark.createDataFrame([(1, d("2000-01-03"), 0.1), (1, d("2000-01-05"), 0.2), (1, days[-1] + dt.timedelta(days=1), 0.3),
                                (2, d("2000-01-05"), 0.4)], "permno long, earnings_date date, earnings_surprise double")
    got = {r.earnings_surprise: r for r in EV.event_labels(ev, bars).collect()}
    assert len(got) == 4
    assert got[0.1].date == days[0] and got[0.2].date == days[1]
    assert got[0.3].date is None and got[0.4].date is None and got[0.4].fwd_ret_5 is None
    assert got[0.2].fwd_ret_5 == pytest.approx(1.01 ** 5 - 1)
    assert got[0.1].post_earnings_drift == pytest.approx(1.01 ** 60 - 1) and got[0.1].drift_end == days[60]


def test_gap_spike_compares_with_the_copy_before(spark):
    rows = [(1, d("2000-01-03"), 1, 10.0, 10.0, 10.0, 10.0, 100),
            (1, d("2000-01-04"), 2, 10.0, 30.0, 10.0, 30.0, 200),  # first copy: against the day before
            (1, d("2000-01-04"), 3, 10.0, 10.0, 10.0, 10.0, 50),  # second copy: against 30
            (1, d("2000-01-05"), 4, 10.0, 10.0, 10.0, 10.0, 10)]  # against the last copy, 10
    df = spark.createDataFrame(rows, "permno long, date date, row_id long, open double, high double, low double, "
                                     "close double, volume long")
    got = {r.row_id: bool(r.flags & 32) for r in nine_rule_flags(df, "2001-01-01").collect()}
    assert got == {1: False, 2: False, 3: True, 4: False}


def test_refresh_same_changed_added_removed(spark):
    def extract(rows):
        return spark.createDataFrame(rows, "permno long, v long, year int, month int")

    old = extract([(1, 1, 2000, 1), (2, 2, 2000, 2), (3, 3, 2000, 3), (4, 4, 2000, 3)])
    new = extract([(1, 1, 2000, 1), (2, 9, 2000, 2), (5, 5, 2000, 4)])
    path = session.scratch_path(spark, "refresh-test")
    old.write.partitionBy("year", "month").parquet(path)
    young = lake.refresh(spark, path, new, ["year", "month"], age_hours=1.0)
    assert young.count() == 0
    got = lake.refresh(spark, path, new, ["year", "month"], age_hours=48.0)
    assert young.columns == got.columns
    assert {(r.month, r.status, r.old_rows, r.new_rows) for r in got.collect()} == {
        (2, "changed", 1, 1), (3, "removed", 2, None), (4, "added", None, 1)}
    stored = lake.read_partitioned(spark, path).select(new.columns)
    assert sorted(stored.collect()) == sorted(new.collect())


def test_a_large_month_is_split_over_writers(spark, tables_small):
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20k")
    try:
        df = tables_small["bars"].select("permno", "close", F.lit("2000-01-03").cast("date").alias("date"))
        path = lake.write_partitioned(df.union(df).union(df), spark, "one-month")
        assert len(lake.read_partitioned(spark, path).inputFiles()) > 1
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)


def test_cluster_without_shared_folder_is_an_error(monkeypatch, spark):
    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_three_sources_keep_their_order(spark):
    panel = spark.createDataFrame([(1, d("2000-01-03")), (1, d("2000-01-04"))], "permno long, date date")

    def fact(name, day):
        return (name, spark.createDataFrame([(1, d(day), name)], f"permno long, eff_{name} date, v_{name} string"),
                f"eff_{name}", [f"v_{name}"], None)

    flows = spark.createDataFrame([(1, d("2000-01-03"), 5.0), (1, d("2000-01-02"), 2.0)], "permno long, date date, x double")
    got = {r.date.day: r for r in attach_point_in_time(
        panel, [fact("a", "2000-01-03"), fact("b", "2000-01-03"), fact("c", "2000-01-04"), fact("e", "2000-01-04")],
        flows=(flows, ["x"], 2)).collect()}
    assert (got[3].v_a, got[3].v_b, got[3].v_c, got[3].v_e, got[3].x) == ("a", "b", None, None, 7.0)
    assert (got[4].v_a, got[4].v_c, got[4].v_e, got[4].x) == ("a", "c", "e", 5.0)


def test_latest_period_of_a_day(spark):
    ev = spark.createDataFrame([(1, d("2000-01-03"), d("1999-12-31"), 0.1), (1, d("2000-01-03"), d("1999-09-30"), 0.2)],
                               "permno long, earnings_date date, fpedats date, earnings_surprise double")
    assert [r.earnings_surprise for r in AN.latest_period(ev).collect()] == [0.1]


def test_noise_is_off_by_default(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 1.0 + 1e-12)], "date int, x double")
    assert all(r.x_z is not None for r in PR.zscore(df, ["x"]).collect())
    assert all(r.x_z is None for r in PR.zscore(df, ["x"], noise=1e-10).collect())


def test_event_model_uses_nothing_from_the_future():
    assert not [c for c in q_models.EVENT_FEATURES if c.startswith("fwd_") or c == "post_earnings_drift"]
