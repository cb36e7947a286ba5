"""Rolling moments from running sums against plain sliding frames, with NaN, infinite and missing values."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions.semantics import Prefix, roll_mean, roll_slope, roll_std, roll_sum

SPANS = (5, 20, 50)
NAN, INF = float("nan"), float("inf")


def series():
    rng = random.Random(7)
    noise = [rng.uniform(-0.05, 0.05) for _ in range(200)]
    hit = lambda at, v: [v if i == at else x for i, x in enumerate(noise)]
    holes = [None if i % 7 == 3 or 60 < i < 130 else x for i, x in enumerate(noise)]
    return {1: noise, 2: hit(40, NAN), 3: hit(40, INF), 4: hit(0, NAN), 5: holes, 6: [None] * 30, 7: [None] * 10 + hit(50, -INF)}


@pytest.fixture(scope="module")
def rolled(spark):
    rng, w = random.Random(8), Window.partitionBy("k").orderBy("i")
    rows = [(k, i, x, rng.uniform(-0.02, 0.02) if i % 11 else None) for k, xs in series().items() for i, x in enumerate(xs)]
    df = spark.createDataFrame(rows, "k int, i int, x double, m double")
    df = df.withColumn("first", F.first("x").over(w))  # a centre that is NaN for one series and NULL for others
    pre = Prefix(w, centers={"x": "first"})
    pre.count("x"), pre.s1("x"), pre.s2("x"), pre.pair("x", "m")
    out = pre.apply(df)
    both = F.col("x").isNotNull() & F.col("m").isNotNull()
    for n in SPANS:
        frame = w.rowsBetween(-(n - 1), 0)
        pairs, slope = roll_slope(w, "x", "m", n)
        out = out.withColumns({
            f"mean{n}": roll_mean(w, "x", n, 2), f"sum{n}": roll_sum(w, "x", n, 2), f"std{n}": roll_std(w, "x", n, 2),
            f"pairs{n}": pairs, f"slope{n}": slope, f"count{n}": F.count("x").over(frame),
            f"want_mean{n}": F.avg("x").over(frame), f"want_sum{n}": F.sum("x").over(frame),
            f"want_std{n}": F.stddev_samp("x").over(frame), f"want_pairs{n}": F.count(F.when(both, 1)).over(frame),
            f"want_slope{n}": F.try_divide(F.covar_pop("x", "m").over(frame), F.var_pop(F.when(both, F.col("m"))).over(frame))})
    return out.collect()


def same(got, want):
    if got is None or want is None:
        return got is None and want is None
    if want != want or abs(want) == INF:
        return got != got
    return got == pytest.approx(want, rel=1e-9, abs=1e-12)


def test_equal_to_plain_frames(rolled):
    assert len(rolled) == sum(len(xs) for xs in series().values())
    for r in rolled:
        for n in SPANS:
            for f in ("mean", "sum", "std"):
                assert same(r[f"{f}{n}"], r[f"want_{f}{n}"] if r[f"count{n}"] >= 2 else None), (f, n, r)
            assert r[f"pairs{n}"] == r[f"want_pairs{n}"]
            if r[f"pairs{n}"] >= 3:
                assert same(r[f"slope{n}"], r[f"want_slope{n}"]), (n, r)


def test_nan_and_infinity_leave_with_their_row(rolled):
    for r in rolled:
        if r.k in (2, 3):
            for n in SPANS:
                held = 40 <= r.i < 40 + n
                for f in ("mean", "sum", "std"):
                    assert (r[f"{f}{n}"] is not None and r[f"{f}{n}"] != r[f"{f}{n}"]) == (held and r[f"count{n}"] >= 2)
