"""Benchmark: the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line.  Each query is executed in full (noop sink, nothing
collected): one warm-up run, then the median of $BENCH_RUNS runs.  Staging the
derived source tables (one write per table) is timed separately.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from hazardline import jobs  # noqa: E402
from hazardline.catalog.registry import reference_params  # noqa: E402
from hazardline.session import build_session  # noqa: E402
from hazardline.sources.fixtures import fixture_sources  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus)

    t0 = time.time()
    src = fixture_sources(spark, sf_dir)
    stage_sec = time.time() - t0
    p = reference_params()

    def all_dates():
        return src.deliveries.select("ship_date").distinct()

    headline = {
        # weekly training for the planned ship dates (curves)
        "train": lambda: jobs.train(spark, src, p),
        # hourly correction for the planned ship dates (training included)
        "correct": lambda: jobs.correct(spark, src, p),
        # live-order actuals on the hourly grid
        "actuals": lambda: jobs.correction_plan(spark, src, p).actuals,
        # back-test: curves for every ship date in the data, one job
        "backtest_train": lambda: jobs.train(spark, src, p, all_dates()),
    }
    out = {}
    for name, build in headline.items():
        times = []
        for i in range(runs + 1):
            t = time.time()
            df = build()  # planning works out the dates, so it belongs to the time
            df.write.format("noop").mode("overwrite").save()
            if i:
                times.append(time.time() - t)
        out[name] = round(statistics.median(times), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(out.values()), 3), "unit": "sec",
        "queries": out, "stage_sources_sec": round(stage_sec, 3), "sf": float(sf) if sf else sf_dir,
        "cpus": cpus, "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
