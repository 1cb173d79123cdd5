"""Benchmark: run the headline queries on $BENCH_SF_DIR (default sf0.1) on
local[$BENCH_CPUS] and print ONE JSON line.

Each query is executed to completion with the ``noop`` sink (every row is
produced, nothing is collected to the driver).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "weekly_segment_features",
    "standardize_prices",
    "macro_grid_ffill",
    "weekly_panel",
    "model_features",
    "distribution_profile",
    "lag_rolling",
    "segment_series",
    "ridge_loo_models",
    "forecast_segments",
    "market_comparison",
    "monitor_summary",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from panelkit.session import get_spark
    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=int(cpus))
    from panelkit.catalog import load_all
    reg = load_all()
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in reg]
    # warm-up: JVM, Python workers, file listing
    reg["weekly_mean"].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.perf_counter()
        reg[name].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_total_runtime", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
