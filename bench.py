"""Benchmark the headline queries.

Runs each query to completion with the ``noop`` sink (full execution, no
driver collection) on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR`` and prints
one JSON line: {"metric", "value", "unit", "queries": {name: sec}, "sf"}.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from hubcast.plans import catalog  # noqa: E402
from hubcast.session import build_session  # noqa: E402

HEADLINE = (
    ("single_run_median", catalog.single_run),
    ("mean_ensemble_submission_all_dates", catalog.mean_submission),
    ("score_table", catalog.score_table),
    ("summary_table_all_history", catalog.summary_table),
    ("relative_skill_ensemble_all_dates", catalog.ensemble_skill_mean),
    ("batch_runs_6_methods_all_dates", catalog.batch_runs),
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = set(sys.argv[1:])
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, cpus),
                          app_name="hubcast-bench")
    # warm the JVM (class loading, codegen caches) on a tiny query
    catalog.week_end_target(spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name, fn in HEADLINE:
        if only and name not in only:
            continue
        t0 = time.perf_counter()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 2)
        print(f"# {name}: {times[name]} s", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 2),
                      "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
