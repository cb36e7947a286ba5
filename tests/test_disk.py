"""What queries leave on the disks: wide rows dealt once, shuffles removed after a write, few columns written."""

import datetime as dt
import time

from test_moves import bars, plan

from pyspark.sql import functions as F

from tidemark.operators import clean as C
from tidemark.operators import flags as FL
from tidemark.operators import pod as P
from tidemark.operators import prep as PR
from tidemark.operators import walkforward as WF
from tidemark.plans import q_factors as QF
from tidemark.plans.catalog import spark_query
from tidemark.session import written

from conftest import SF_SMALL


def test_the_pod_moves_the_bars_once(spark):
    b = bars(spark, 40)
    market = b.groupBy("date").agg((F.avg("close") / 1000).alias("vwretd"))
    out = plan(P.build_pod(b, upto=5, market=market))
    assert out.count("Exchange hashpartitioning") == 1 and "pod-split" not in out


def test_rows_without_a_day_have_no_place_in_the_series(spark):
    b = bars(spark, 40)
    odd = b.limit(3).withColumn("date", F.lit(None).cast("date")).unionByName(b.limit(2).withColumn("permno", F.lit(None).cast("long")))
    got, want = (P.build_pod(x, upto=2).select("permno", "date", "P_5", "OBV").collect() for x in (b.unionByName(odd), b))
    assert sorted(map(str, got)) == sorted(map(str, want)) and len(got) == 80


def test_the_panel_moves_narrow_rows_only(spark, tables_small):
    below = plan(QF.factor_panel(tables_small)).split("Exchange hashpartitioning(permno", 1)[1]
    assert "Union" in below and "lag(close" not in below and "pod-split" not in below


def test_known_values_come_through_the_pod(spark, tables_small):
    rows = QF.panel_rows(tables_small)
    assert not {"_known", "_bar"} & set(rows.columns) and len(rows.columns) == len(set(rows.columns))
    assert rows.filter("book_to_market IS NOT NULL").count() > 0 and rows.count() == tables_small["bars"].count()


def test_a_write_removes_the_shuffles_behind_it(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    spark._jvm.System.gc()
    time.sleep(2)
    before = disk.getAllFiles().size()
    out = written(bars(spark, 50).repartition(4, "permno").groupBy("date").agg(F.sum("close").alias("x")), "shuffle-test")
    for _ in range(20):
        if disk.getAllFiles().size() <= before:
            break
        time.sleep(0.5)
    assert disk.getAllFiles().size() <= before and out.count() == 50


def test_percentiles_of_few_columns_at_a_time(spark, monkeypatch):
    df = bars(spark, 30, securities=range(1, 8)).select("permno", "date", "open", "high", "close", (F.col("close") * F.col("permno")).alias("low"))
    cols, names = ["open", "high", "low", "close"], []
    want = PR.winsorise(df, cols).collect()
    keep = PR.written
    monkeypatch.setattr(PR, "written", lambda d, name: names.append(name) or keep(d, name))
    monkeypatch.setattr(PR, "BOUND_COLUMNS", 3)
    assert sorted(PR.winsorise(df, cols).collect()) == sorted(want)
    assert names == ["winsor-input", "winsor-bounds", "winsor-bounds"]


def test_flags_deal_only_what_is_read(spark, monkeypatch):
    seen, keep = [], FL.written
    monkeypatch.setattr(FL, "written", lambda d, name: seen.append(set(d.columns)) or keep(d, name))
    for name, more in (("f16_flags_cleaner", ()), ("f10_flags_nine_rule", ()), ("d02_dedupe_cleaner", C.CLEANER_FIRST), ("g06_pipeline_cleaner", C.CLEANER_FIRST)):
        spark_query(name, spark, SF_SMALL)
        assert seen.pop() == {*FL.FLAG_INPUTS, *more, "_range"}, name


def test_the_matrix_is_not_moved_by_month(spark, monkeypatch):
    monkeypatch.setattr(WF, "rebalanced", lambda *_: 1 / 0)
    deleted, keep = [], WF.delete_folder
    monkeypatch.setattr(WF, "delete_folder", lambda s, path: deleted.append(path) or keep(s, path))
    b = bars(spark, 60, securities=range(1, 6)).select("permno", "date", "close", "volume")
    known = WF.with_labels(b).select("*", *[F.col("permno").cast("double").alias(c) for c in WF.EVENT_FEATURES])
    got = spark.read.parquet(WF.store_matrix(known, ["close"]))
    want = WF.feature_matrix(known, ["close"])
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect())) and got.count() == 300
    assert len(deleted) == 1 and "matrix-rows" in deleted[0]
    first = dt.date(2000, 1, 3)
    assert {r.month for r in got.select("month").distinct().collect()} == {(first + dt.timedelta(days=k)).month + 359 for k in range(60)}
