"""Run the named queries and compare each with its SQL equivalent in DuckDB.

Usage: python tools/check_queries.py [--sf DIR] [--large] [name or prefix ...]
With --large every input counts as too big for one task, so the range-partitioned plans run.
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time
import traceback

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tabkit.catalog import QUERIES, SQL  # noqa: E402
from tabkit.plans import ordered as ordered_plans  # noqa: E402
from tabkit.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def plain(value: object) -> object:
    if isinstance(value, float):
        return None if math.isnan(value) else (0.0 if value == 0 else value)
    return value


def ordered(names: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    places = sorted(range(len(names)), key=lambda i: names[i])
    shuffled = [tuple(plain(r[i]) for i in places) for r in rows]
    return [names[i] for i in places], sorted(shuffled, key=lambda r: tuple((v is None, str(v)) for v in r))


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("--large", action="store_true")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = local_session(8)
    if args.large:
        spark.conf.set("spark.tabkit.smallBytes", "1")
        ordered_plans.TINY_BYTES = 0
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{args.sf}/{table}.parquet'")
    bad = 0
    for name, run in QUERIES.items():
        if args.names and not any(name.startswith(n) for n in args.names):
            continue
        start = time.time()
        try:
            df = run(spark, args.sf)
            rows = [tuple(r) for r in df.collect()]
            took = time.time() - start
            got = ordered(df.columns, rows)
            if name not in SQL:
                print(f"rows  {name:28s} {len(rows):8d} rows {took:6.2f}s", flush=True)
                continue
            cursor = con.execute(SQL[name])
            names = [d[0] for d in cursor.description]
            want = ordered(names, cursor.fetchall())
        except Exception as exc:  # noqa: BLE001 - report and go on with the next query
            bad += 1
            print(f"ERROR {name}: {str(exc)[:1500]}", flush=True)
            if os.environ.get("TRACE"):
                traceback.print_exc()
            continue
        if got == want:
            print(f"ok    {name:28s} {len(rows):8d} rows {took:6.2f}s", flush=True)
            continue
        bad += 1
        print(f"DIFF  {name}: columns {got[0]} / {want[0]}; rows {len(got[1])} / {len(want[1])}", flush=True)
        shown = 0
        for a, b in zip(got[1], want[1]):
            if a != b and shown < 4:
                shown += 1
                print("   got ", str(a)[:300], "\n   want", str(b)[:300], flush=True)
    print("failures:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
