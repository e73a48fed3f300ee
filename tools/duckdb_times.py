"""Time each oracle SQL in DuckDB (single process) over the same tables.

Usage: python tools/duckdb_times.py [sf_dir] [threads]
Prints one JSON line {query: best-of-3 seconds}. Used only as a single-node
"""

import json
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillroll.plans.registry import all_queries  # noqa: E402
from tillroll.sources.tables import TABLES  # noqa: E402


def main(argv):
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    threads = int(argv[2]) if len(argv) > 2 else 8
    con = duckdb.connect()
    con.execute(f"SET threads = {threads}")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    out = {}
    for name, q in all_queries().items():
        if not q.sql:
            continue
        best = None
        for _ in range(3):
            t0 = time.perf_counter()
            con.sql(q.sql).fetch_arrow_table()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        out[name] = round(best, 4)
    print(json.dumps({"engine": "duckdb", "threads": threads, "sf_dir": sf,
                      "total": round(sum(out.values()), 3), "queries": out}))


if __name__ == "__main__":
    main(sys.argv)
