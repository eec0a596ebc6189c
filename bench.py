"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Every query is built from the raw driver tables in a fresh plan context
(no stage output shared between queries) and fully materialized with a
no-op write, so the timing covers the whole chain behind it.  Prints one
JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stockpulse import plans  # noqa: E402
from stockpulse.session import get_session, release_tables  # noqa: E402

HEADLINE = [
    "clean_sales",          # cleaning over the dirtied sales extract
    "weekly_features",      # dense weekly feature table (W1-W26)
    "customer_segments",    # RFM with distributed quintile ranks
    "baseline_metrics",     # holdout backtest metrics
    "risk_scores",          # flagship: forecast rollout + inventory risk
    "ridge_forecast",       # ridge fit + refit + 8-week forecast
    "scenario_sweep",       # what-if sweep over all SKUs
    "question_answers",     # canned business questions
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = get_session(f"local[{cpus}]", int(cpus) * 2,
                        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    # JVM warm-up (JIT, generated-code caches) on the smallest tables, untimed
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if warm_dir and os.path.isdir(warm_dir):
        for name in names:
            plans.run(name, spark, warm_dir, fresh=True).write.format("noop").mode("overwrite").save()
            release_tables()
    timings = {}
    for name in names:
        t0 = time.perf_counter()
        df = plans.run(name, spark, sf_dir, fresh=True)
        df.write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t0, 3)
        release_tables()
        print(f"# {name}: {timings[name]}s", file=sys.stderr)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_query_wall_time", "value": round(sum(timings.values()), 3),
                      "unit": "sec", "queries": timings, "sf": sf, "warmup": os.path.basename(warm_dir)}))
    spark.stop()


if __name__ == "__main__":
    main()
