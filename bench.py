"""Wall time of the registered queries; prints one JSON line.

BENCH_SF_DIR, BENCH_CPUS and BENCH_QUERIES (a comma list) choose data, cores and
queries. Each result is consumed in full. A short untimed query warms the JVM up.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from addrwatch.catalog import QUERIES  # noqa: E402
from addrwatch.session import build_session  # noqa: E402


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES")
    names = wanted.split(",") if wanted else list(QUERIES)
    spark = build_session(cpus, "bench")
    for name in ("class_profile", "a9_roc_curve"):
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - started, 3)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"), "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
