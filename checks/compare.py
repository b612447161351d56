"""Run registered queries in Spark and their SQL counterparts in DuckDB, and compare the rows.

``python -m checks.compare [--sf DIR] [name ...]``
"""

from __future__ import annotations

import argparse
import collections
import datetime as dt
import decimal
import sys
import time
from pathlib import Path
from typing import Any

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def normal(value: Any) -> Any:
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, (list, tuple)):
        return tuple(normal(v) for v in value)
    return value


def kind(value: Any) -> str:
    return "null" if value is None else type(value).__name__


def rows_of(columns: list[str], rows: list[tuple]) -> collections.Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return collections.Counter(tuple(normal(r[i]) for i in order) for r in rows)


def duck(sf_dir: str) -> Any:
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        if Path(f"{sf_dir}/{t}.parquet").exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark: Any, con: Any, sf_dir: str, build: Any, sql: str | None) -> tuple[str, int, float]:
    started = time.time()
    df = build(spark, sf_dir)
    got_rows = [tuple(r) for r in df.collect()]
    seconds = time.time() - started
    if sql is None:
        return "rows only", len(got_rows), seconds
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want_rows = cur.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}", len(got_rows), seconds
    got, want = rows_of(df.columns, got_rows), rows_of(names, want_rows)
    if got != want:
        missing, extra = list((want - got).items())[:2], list((got - want).items())[:2]
        return f"rows {sum(got.values())} vs {sum(want.values())}; missing {missing}; extra {extra}", len(got_rows), seconds
    for i, name in enumerate(df.columns):
        types = {kind(r[i]) for r in got_rows} - {"null"}
        j = names.index(name)
        other = {kind(r[j]) for r in want_rows} - {"null"}
        if types != other:
            return f"type of {name}: {types} vs {other}", len(got_rows), seconds
    return "ok", len(got_rows), seconds


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("names", nargs="*")
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    args = parser.parse_args()
    from checks.queries import oracle_sql, queries
    from fleetgauge.session import local_session

    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(args.sf)
    known, sql = queries(), oracle_sql()
    bad = 0
    for name in args.names or known:
        try:
            verdict, n, seconds = compare(spark, con, args.sf, known[name], sql.get(name))
        except Exception as error:  # report and go on with the next query
            verdict, n, seconds = f"error {str(error)[:600]}", 0, 0.0
        good = verdict in ("ok", "rows only")
        bad += not good
        print(f"{'  ' if good else '! '}{name:32s} {n:8d} rows {seconds:6.2f} s  {verdict}", flush=True)
    print(f"{bad} differences")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
