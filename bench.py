"""Seconds per headline query on local Spark; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma-separated names, default all but the
*_sliced twins, which force the split path of another query), BENCH_RUNS (default 2,
the best one counts).
"""

from __future__ import annotations

import json
import os
import time

from siltstone.session import build_session
from testbed.queries import QUERIES

DEFAULT_SF = "/root/testdata/sf0.1"


def seconds(spark, sf: str, name: str) -> float:
    """The whole result is produced, as a write would, without leaving the JVM."""
    started = time.perf_counter()
    QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", DEFAULT_SF)
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = os.environ.get("BENCH_QUERIES", "")
    names = [n for n in names.split(",") if n] or [q for q in QUERIES if not q.endswith("_sliced")]
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false", spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds(spark, sf, "status_counts")  # start-up is not part of any query
    taken = {n: round(min(seconds(spark, sf, n) for _ in range(runs)), 3) for n in names}
    print(json.dumps({
        "metric": "total_query_time", "value": round(sum(taken.values()), 3), "unit": "sec",
        "queries": taken, "sf": os.path.basename(sf.rstrip("/")),
    }), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
