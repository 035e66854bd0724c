"""Compare registered queries with their SQL: python tools/compare.py SF_DIR [name ...]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402

from shopgrain.catalog import ORACLE, QUERIES  # noqa: E402
from shopgrain.session import local_session  # noqa: E402

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def connect(folder: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def _sortable(row: tuple) -> tuple:
    return tuple((value is None, str(type(value)), str(value)) for value in row)


def difference(spark_df, con, sql: str) -> str | None:
    """None when rows, names and values agree exactly, else what differs."""
    relation = con.sql(sql)
    theirs_names = relation.columns
    columns = sorted(spark_df.columns)
    if columns != sorted(theirs_names):
        return f"columns {columns} against {sorted(theirs_names)}"
    ours = sorted((tuple(row[c] for c in columns) for row in spark_df.collect()), key=_sortable)
    places = [theirs_names.index(c) for c in columns]
    theirs = sorted((tuple(row[p] for p in places) for row in relation.fetchall()), key=_sortable)
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    for a, b in zip(ours, theirs):
        for name, x, y in zip(columns, a, b):
            same = x == y or (isinstance(x, float) and isinstance(y, float) and math.isnan(x) and math.isnan(y))
            if not same or type(x) is not type(y):
                return f"{name}: {x!r} against {y!r} in {a} / {b}"
    return None


def main() -> int:
    folder, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(folder), 0
    for name in names:
        start = time.time()
        try:
            df = QUERIES[name](spark, folder)
            problem = difference(df, con, ORACLE[name]) if name in ORACLE else f"no SQL, {df.count()} rows"
        except Exception as error:  # noqa: BLE001 - a report, not a program
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return failed


if __name__ == "__main__":
    sys.exit(main())
