"""Compare registered queries with their DuckDB oracles: ``python tests/oracle.py [folder] [name ...]``."""

from __future__ import annotations

import datetime as dt
import sys
import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402

SOURCES = "region nation customer supplier part orders lineitem events documents benchmark".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in SOURCES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, Decimal):
        return format(value.normalize() if value else Decimal(0), "f")
    if isinstance(value, float):
        return f"{value:.6g}"
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value if value is None else str(value)


def as_bag(columns: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    mine = as_bag(spark_df.columns, spark_df.collect())
    result = con.execute(sql)
    theirs = as_bag([d[0] for d in result.description], result.fetchall())
    if mine[0] != theirs[0]:
        return False, f"columns {mine[0]} / {theirs[0]}"
    extra, missing = mine[1] - theirs[1], theirs[1] - mine[1]
    rows = sum(mine[1].values())
    if extra or missing:
        return False, f"{rows} rows, {sum(extra.values())} extra {list(extra)[:2]}, {sum(missing.values())} missing {list(missing)[:2]}"
    return True, f"{rows} rows"


def main(argv: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from tidewake.session import local_session

    folder = argv[0] if argv else "/root/testdata/sf0.01"
    spark, con, sql = local_session("oracle", 8), connect(folder), oracle_sql()
    bad = []
    for name, run in queries().items():
        if argv[1:] and not any(name.startswith(a) for a in argv[1:]):
            continue
        start = time.time()
        try:
            ok, note = compare(run(spark, folder), con, sql[name])
        except Exception as error:  # report and go on
            ok, note = False, str(error)[:700]
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.1f}s {note}", flush=True)
        bad += [] if ok else [name]
    print("failed:", bad)
    return len(bad)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
