"""Seconds DuckDB takes for each query's SQL on the same files, as one JSON line.

    python -m testbed.baseline [sf_dir]
"""

from __future__ import annotations

import json
import sys
import time

from testbed.check import connect
from testbed.oracle import ORACLE


def main(argv: list[str]) -> None:
    con = connect(argv[0] if argv else "/root/testdata/sf0.1")
    con.execute("set threads to 8")
    taken = {}
    for name, sql in ORACLE.items():
        best = float("inf")
        for _ in range(2):
            started = time.perf_counter()
            con.sql(sql).to_arrow_table()
            best = min(best, time.perf_counter() - started)
        taken[name] = round(best, 3)
    print(json.dumps({"value": round(sum(taken.values()), 3), "queries": taken}))


if __name__ == "__main__":
    main(sys.argv[1:])
