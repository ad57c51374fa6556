"""Compare every query with its SQL: ``python -m checks.compare [folder] [names...]``."""

from __future__ import annotations

import sys
import time
import traceback

import duckdb
import pandas as pd

from .oracle import ORACLE
from .queries import QUERIES
from .session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def canonical(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    rows = [
        tuple(None if v is None or v is pd.NaT or v is pd.NA or v != v
              else round(float(v), 9) if isinstance(v, (int, float)) and not isinstance(v, bool)
              else v for v in row)
        for row in frame.astype(object).itertuples(index=False)
    ]
    return sorted(rows, key=repr)


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    """What differs between two results, None if nothing does."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} vs {sorted(want.columns)}"
    left, right = canonical(got), canonical(want)
    if left == right:
        return None
    extra = [r for r in left if r not in set(right)][:2]
    missing = [r for r in right if r not in set(left)][:2]
    return f"{len(left)} vs {len(right)} rows; only Spark {extra}; only SQL {missing}"


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark, con, bad = local_session(), connect(folder), 0
    for name in names:
        began = time.time()
        try:
            got = QUERIES[name](spark, folder).toPandas()
            spent = time.time() - began
            if name not in ORACLE:
                print(f"rows  {name:28s} {len(got):7d} {spent:6.1f}s", flush=True)
                continue
            began = time.time()
            problem = difference(got, con.execute(ORACLE[name]).df())
            print(f"{'FAIL ' if problem else 'ok   '} {name:28s} {len(got):7d} {spent:6.1f}s "
                  f"sql {time.time() - began:.1f}s {str(problem)[:900] if problem else ''}", flush=True)
            bad += bool(problem)
        except Exception as error:
            bad += 1
            print(f"ERROR {name}: {str(error)[:500]} {traceback.format_exc()[-300:]}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
