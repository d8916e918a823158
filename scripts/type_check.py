"""Compare Spark result column types with DuckDB oracle result types."""
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import duckdb  # noqa: E402

from voyra.plans.registry import ORACLE, QUERIES, load_all  # noqa: E402
from voyra.session import build_session  # noqa: E402

MAP = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
       "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE",
       "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT"}

sf = "/root/testdata/sf0.001"
load_all()
spark = build_session()
con = duckdb.connect()
for t in ["events", "documents", "pages", "labels", "conversations", "benchmark"]:
    con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
keys = sys.argv[1:] or list(ORACLE)
bad = 0
for k in keys:
    df = QUERIES[k](spark, sf)
    s = {n: MAP.get(t, t) for n, t in df.dtypes}
    res = con.execute(f"SELECT * FROM ({ORACLE[k]}) LIMIT 0")
    d = {c[0]: str(c[1]) for c in res.description}
    diff = {n: (s.get(n), d.get(n)) for n in set(s) | set(d) if s.get(n) != d.get(n)}
    if diff:
        bad += 1
        print(f"{k:22s} {diff}")
print("mismatching queries:", bad)
