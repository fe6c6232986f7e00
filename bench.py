"""Benchmark: run every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS]
and print one JSON line with per-query wall times (seconds).

Each query is executed in full with the ``noop`` writer (all rows produced,
nothing collected to the driver). The first pass over the catalog warms the
JVM; the reported time per query is the best of ``$BENCH_REPEAT`` timed runs.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tradeflow.plans import catalog, chains_and_trends  # noqa: E402
from tradeflow.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    only = set(filter(None, os.environ.get("BENCH_QUERIES", "").split(",")))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus, app_name="tradeflow-bench",
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g")})
    qs = {k: v for k, v in (catalog.queries() | chains_and_trends.queries()).items() if not only or k in only}

    def run(fn):
        t0 = time.perf_counter()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for fn in qs.values():          # warm-up pass
        run(fn)
    times = {name: round(min(run(fn) for _ in range(repeat)), 3) for name, fn in qs.items()}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
