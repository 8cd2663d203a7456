"""Time every oracle SQL in in-process DuckDB on one scale factor (single-node reference
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from quayside.plans import catalog  # noqa: E402
from quayside.sources.tables import TABLES, table_path  # noqa: E402

sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
threads = int(sys.argv[2]) if len(sys.argv) > 2 else 8
con = duckdb.connect()
con.execute(f"SET threads={threads}")
for t in TABLES:
    con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
out = {}
for name, sql in catalog.ORACLES.items():
    best = float("inf")
    for _ in range(3):
        t0 = time.perf_counter()
        con.sql(sql).fetchall()
        best = min(best, time.perf_counter() - t0)
    out[name] = round(best, 3)
print(json.dumps(out))
