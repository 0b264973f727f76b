"""Benchmark: wall time of the headline catalogue queries.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default the set below). Each query is executed in full
with the ``noop`` sink (no result is pulled to the driver). A warm-up run on the
smallest data set loads classes first. Prints one JSON line; ``measure_sec`` is the size
measurement of the base tables (part of ``value``), ``cpu_probe_sec`` a fixed pure-Python
loop timed before the queries, to compare runs across machine states.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from seasonflow.plans import QUERIES  # noqa: E402
from seasonflow.session import local_session  # noqa: E402

DEFAULT = [
    "seasonality_index", "seasonal_ratio", "win_ma_even", "agg_group_stats",
    "win_ratio_to_mean", "agg_nested_stats", "prj_rawdata", "flt_param_driven",
    "join_left_star", "fn_share_residual", "arr_explode", "reshape_unpivot", "srt_topk",
    "ml_compare",
]


def cpu_probe() -> float:
    """Seconds for a fixed pure-Python loop: a machine-speed reference for comparing
    runs made under different machine states (not part of the timed value)."""
    t0 = time.perf_counter()
    total = 0
    for i in range(5_000_000):
        total += i
    return round(time.perf_counter() - t0, 3)


def run(spark, name, sf_dir):
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [q for q in os.environ.get("BENCH_QUERIES", ",".join(DEFAULT)).split(",") if q]
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
                          app="seasonflow-bench")
    warm_dir = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(warm_dir):
        run(spark, "seasonality_index", warm_dir)
    # Base tables are measured once per session and state of their files: timed by itself, not
    # as part of the query that happens to come first.
    t0 = time.perf_counter()
    QUERIES["seasonality_index"](spark, sf_dir)
    measure = round(time.perf_counter() - t0, 3)
    probe = cpu_probe()
    times = {}
    for name in names:
        times[name] = round(run(spark, name, sf_dir), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_wall_time_headline_queries",
        "value": round(measure + sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "measure_sec": measure,
        "cpu_probe_sec": probe,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
