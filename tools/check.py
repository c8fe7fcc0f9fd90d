"""Run registered queries on Spark and their SQL on DuckDB and compare whole results.

Usage: python tools/check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from driver_queries import load  # noqa: E402
from driver_queries.base import TABLES  # noqa: E402
from signpost.session import local_session  # noqa: E402


def plain(value):
    if value is None:
        return None
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, bool):
        return ("b", value)
    if isinstance(value, float):
        if math.isnan(value):
            return ("f", "nan")
        return ("f", round(value, 9))
    if isinstance(value, int):
        return ("i", value)
    return (type(value).__name__, str(value))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def main() -> int:
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    queries, oracles = load()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    spark = local_session("8")
    bad = []
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf)
            got = df.collect()
            took = time.time() - start
            line = f"{name:28s} rows={len(got):7d} {took:6.1f}s"
            if name in oracles:
                rel = con.execute(oracles[name])
                cols = [d[0] for d in rel.description]
                want = rel.fetchall()
                if sorted(cols) != sorted(df.columns):
                    line += f"  COLUMNS differ {sorted(set(cols) ^ set(df.columns))}"
                    bad.append(name)
                else:
                    a, b = rows_of(df.columns, got), rows_of(cols, want)
                    if a == b:
                        line += "  ok" + ("" if a else " (EMPTY)")
                    else:
                        bad.append(name)
                        diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
                        line += f"  DIFF rows {len(a)} vs {len(b)} {sorted(cols)}\n   " + "\n   ".join(map(str, diff))
            print(line, flush=True)
        except Exception as error:  # noqa: BLE001
            bad.append(name)
            print(f"{name:28s} FAILED {type(error).__name__}: {str(error)[:900]}", flush=True)
    print("bad:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
