"""Run every registered query beside its DuckDB SQL and compare all rows.

    python -m testbed.check [sf_dir] [query ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

from siltstone.session import build_session
from testbed.oracle import ORACLE
from testbed.queries import QUERIES


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def rows_of(frame_rows, columns) -> list:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(plain(r[i]) for i in order) for r in frame_rows]
    return sorted(rows, key=lambda r: [(v is None, str(v)) for v in r])


def types_of(relation) -> dict[str, str]:
    return dict(zip(relation.columns, (str(t) for t in relation.types)))


SAME_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


def compare(spark, con, sf: str, name: str) -> tuple[bool, str]:
    started = time.time()
    df = QUERIES[name](spark, sf)
    got = rows_of(df.collect(), df.columns)
    took = time.time() - started
    if name not in ORACLE:
        return True, f"{len(got)} rows, no SQL ({took:.1f}s)"
    relation = con.sql(ORACLE[name])
    wanted = rows_of(relation.fetchall(), relation.columns)
    if sorted(df.columns) != sorted(relation.columns):
        return False, f"columns {sorted(df.columns)} against {sorted(relation.columns)}"
    types = types_of(relation)
    for column, kind in df.dtypes:
        if SAME_TYPE.get(kind, kind) != types[column]:
            return False, f"{column}: {kind} against {types[column]}"
    if got != wanted:
        pairs = [(g, w) for g, w in zip(got, wanted) if g != w][:2]
        return False, f"{len(got)} against {len(wanted)} rows; first differences {pairs}"[:1500]
    return True, f"{len(got)} rows ({took:.1f}s)"


def main(argv: list[str]) -> int:
    sf = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark = build_session(
        "check", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    failed = []
    for name in names:
        try:
            ok, note = compare(spark, con, sf, name)
        except Exception as e:  # noqa: BLE001 - report every query
            ok, note = False, f"{type(e).__name__}: {str(e)[:1200]}"
        print("ok  " if ok else "FAIL", name, note, flush=True)
        if not ok:
            failed.append(name)
    print(f"{len(names) - len(failed)} of {len(names)} match", failed)
    return len(failed)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
