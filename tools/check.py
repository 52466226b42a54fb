"""Run queries next to their SQL oracle and report every difference.

    python tools/check.py [--sf 0.01] [--only name,name | --match text] [--times]
"""

from __future__ import annotations

import argparse
import os
import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from ledgerline.plans.registry import load_all  # noqa: E402
from ledgerline.session import local_session  # noqa: E402

TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP",
}


def oracle_connection(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(os.listdir(folder)):
        if file.endswith(".parquet"):
            con.execute(f"CREATE VIEW {file[:-8]} AS SELECT * FROM read_parquet('{folder}/{file}')")
    return con


def canon(value):
    if isinstance(value, float):
        return float(f"{value + 0.0:.9g}")
    if isinstance(value, Decimal):
        return str(value)
    return value


def compare(df, con, sql: str) -> list[str]:
    """Problems found; an empty list means equal schema and rows."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]) for d in cursor.description}
    expected = cursor.fetchall()
    problems = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    for field in df.schema.fields:
        kind = field.dataType.simpleString()
        wanted = TYPES.get(kind, kind.upper())
        if wanted != types[field.name].replace(" ", ""):
            problems.append(f"type of {field.name}: {kind} != {types[field.name]}")
    order = sorted(names)
    at = [names.index(n) for n in order]
    right = Counter(tuple(canon(r[i]) for i in at) for r in expected)
    left = Counter(tuple(canon(r[n]) for n in order) for r in df.collect())
    if left != right:
        only_left, only_right = left - right, right - left
        problems.append(
            f"rows {sum(left.values())} vs {sum(right.values())}; {order}; "
            f"spark only {list(only_left)[:3]}; sql only {list(only_right)[:3]}"
        )
    elif not expected:
        problems.append("no rows on either side")
    return problems


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("--only", default="")
    parser.add_argument("--match", default="")
    parser.add_argument("--times", action="store_true")
    args = parser.parse_args()
    folder = f"/root/testdata/sf{args.sf}"
    catalog = load_all()
    names = [n for n in args.only.split(",") if n] or [n for n in catalog if args.match in n]
    spark, con = local_session(8), oracle_connection(folder)
    failed, times = [], {}
    for name in names:
        start = time.time()
        try:
            df = catalog[name](spark, folder)
            sql = catalog[name].oracle
            problems = compare(df, con, sql) if sql else ([] if df.count() else ["no rows"])
        except Exception as error:  # one broken query must not hide the others
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        times[name] = time.time() - start
        if problems:
            failed.append(name)
            print(f"FAIL {name}")
            for problem in problems:
                print("    ", problem)
    if args.times:
        for name, seconds in sorted(times.items(), key=lambda item: -item[1])[:30]:
            print(f"{seconds:6.2f} {name}")
    print(f"{len(names) - len(failed)} of {len(names)} ok; {sum(times.values()):.0f} s; failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
