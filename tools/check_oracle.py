"""Run registered queries next to their oracle SQL and compare the results.

usage: python tools/check_oracle.py [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from riskloom.plans.catalog import REGISTRY  # noqa: E402
from riskloom.plans.registry import as_callable  # noqa: E402
from riskloom.session import local_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
         "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    return repr(v)


def compare(df, con, sql, clock) -> str:
    names = sorted(df.columns)
    got = [tuple(r[n] for n in names) for r in df.collect()]
    clock.append(time.time())
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    types = {d[0]: str(d[1]) for d in cur.description}
    if sorted(cols) != names:
        return f"columns differ: spark {names} oracle {sorted(cols)}"
    order = [cols.index(n) for n in names]
    want = [tuple(r[i] for i in order) for r in cur.fetchall()]
    spark_types = dict(df.dtypes)
    bad = [f"{n}: {spark_types[n]} vs {types[n]}" for n in names
           if KINDS.get(spark_types[n], spark_types[n]) != types[n] and not spark_types[n].startswith("decimal")]
    a = sorted(tuple(map(norm, r)) for r in got)
    b = sorted(tuple(map(norm, r)) for r in want)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y]
        shown = [(tuple(s[:60] for s in x), tuple(s[:60] for s in y)) for x, y in diff[:2]]
        return f"rows {len(a)} vs {len(b)}, {len(diff)} differ: {shown}"
    if bad:
        return "types differ: " + "; ".join(bad)
    return f"ok {len(a)} rows"


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    sf_dir = f"/root/testdata/sf{args.sf}"
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name, q in REGISTRY.items():
        if args.names and name not in args.names and not any(q.build.__module__.endswith(n) for n in args.names):
            continue
        start, clock = time.time(), []
        try:
            df = as_callable(q)(spark, sf_dir)
            verdict = compare(df, con, q.sql, clock) if q.sql else f"rows only: {len(df.collect())}"
        except Exception as exc:  # report and go on with the next query
            verdict = f"FAILED {type(exc).__name__}: {str(exc)[:600]}"
        good = verdict.startswith(("ok", "rows only"))
        failed += not good
        print(f"{'  ' if good else '!!'} {name:34s} {(clock or [time.time()])[0] - start:6.1f}s +{time.time() - (clock or [time.time()])[0]:5.1f}s {verdict}", flush=True)
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
