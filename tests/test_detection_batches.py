"""M-03: the estimates are aggregated once, however many batches of announcements arrive."""

import datetime as dt

from tidemark.operators import analysts as AN
from tidemark.session import scratch_path
from tidemark.sources import extracts as X
from tidemark.streaming import live as L

D = dt.date


def test_consensus_is_aggregated_once_for_all_batches(spark, monkeypatch):
    est = spark.createDataFrame([(p, a, D(2000, 1, 10 + a), D(2000, 3, 31), 1.0 + 0.1 * a) for p in (1, 2, 3) for a in range(3)],
                                "permno long, analyst long, estdate date, fpedats date, est double")
    calls, keep = [], X.consensus
    for module in (X, AN):
        monkeypatch.setattr(module, "consensus", lambda df: calls.append(1) or keep(df))
    batch, out = L.earnings_detection_batch(est), scratch_path(spark, "m03-test")
    schema = "permno long, anndats date, fpedats date, actual double"
    for k, rows in enumerate(([(1, D(2000, 4, 20), D(2000, 3, 31), 2.2), (2, D(2000, 4, 20), D(2000, 3, 31), 1.1)],
                              [(3, D(2000, 4, 21), D(2000, 3, 31), 0.55), (4, D(2000, 4, 21), D(2000, 3, 31), 9.0)])):
        batch(spark.createDataFrame(rows, schema), k, out)
    got = {r.permno: round(r.earnings_surprise, 6) for r in L.read_sink(spark, out).collect()}
    assert got == {1: 1.0, 3: -0.5} and len(calls) == 1
