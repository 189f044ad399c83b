"""Run queries on Spark and their SQL forms on DuckDB and compare the values.

    python -m checks.compare [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import hashlib
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def normal(value) -> str:
    if value is None:
        return "\\N"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, float):
        return repr(round(value, 6) + 0.0)
    return str(value)


def digest(columns: list[str], rows) -> tuple[int, str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("\x1f".join(normal(r[i]) for i in order) for r in rows)
    return len(lines), hashlib.md5("\x1e".join(lines).encode()).hexdigest()


def connect(sf: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def check(spark, sf: str, name: str, fn, sql: str | None, con) -> tuple[bool, str]:
    begin = time.time()
    df = fn(spark, sf)
    rows = df.collect()
    took = time.time() - begin
    if sql is None:
        return True, f"{name}: rows only, {len(rows)} rows, {took:.1f}s"
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return False, f"{name}: columns {sorted(df.columns)} against {sorted(names)}"
    mine, theirs = digest(df.columns, rows), digest(names, expected)
    ok = mine == theirs
    note = f"{name}: {'ok' if ok else 'DIFFERENT'} {mine[0]} rows against {theirs[0]}, {took:.1f}s"
    if not ok:
        order = sorted(names)
        a = {tuple(normal(r[df.columns.index(c)]) for c in order) for r in rows}
        b = {tuple(normal(r[names.index(c)]) for c in order) for r in expected}
        note += f"\n   {order}\n   spark only: {sorted(a - b)[:3]}\n   sql only:   {sorted(b - a)[:3]}"
    return ok, note


def main() -> int:
    from boxloom.session import local_session
    from checks import ORACLES, QUERIES

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark, con = local_session(8), connect(args.sf)
    failed = []
    for name, fn in QUERIES.items():
        if args.names and not any(name.startswith(n) for n in args.names):
            continue
        try:
            ok, note = check(spark, args.sf, name, fn, ORACLES.get(name), con)
        except Exception as error:
            ok, note = False, f"{name}: FAILED {str(error)[:1500]}"
        print(note, flush=True)
        if not ok:
            failed.append(name)
    print(f"failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
