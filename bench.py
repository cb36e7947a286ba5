"""Bench: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; print one JSON line.

Each query is executed to completion with a no-op sink (the full plan runs, nothing
is collected to the driver). Reported per query: median of ``BENCH_REPS`` runs after
one warm-up run of the whole set.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.plans.catalog import load_all, spark_query  # noqa: E402
from tidemark.session import build_session  # noqa: E402

# Fixed value: the headline set (one query per stage of the research chain).
HEADLINE = [
    "a01_price_extract", "g05_pipeline_nine_rule", "g06_pipeline_cleaner", "h_pod_pass2", "h_pod_pass3_5",
    "e08_risk_columns", "c08_fundamentals_asof", "i18_analyst_events", "e13_insider_trailing",
    "k06_factor_panel", "k02_factor_zscores", "e15_rank_top100", "l04_historical_drift", "l14_decile_returns",
    "m02_stream_bars", "l07_factor_model_predictions", "l08_event_model_predictions",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "1"))
    names = os.environ.get("BENCH_QUERIES")
    names = names.split(",") if names else HEADLINE
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(max(8, cpus * 2))))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=parts, app_name="tidemark-bench")
    load_all()

    from tidemark.plans.q_models import forget_shared

    def run(name: str) -> float:
        forget_shared()
        t0 = time.perf_counter()
        spark_query(name, spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for n in names:  # warm-up: JIT, file listing, codegen caches
        run(n)
    times = {n: round(statistics.median(run(n) for _ in range(reps)), 3) for n in names}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
