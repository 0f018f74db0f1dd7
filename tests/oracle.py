"""Compare registered queries with their SQL, run by DuckDB on the same files.

`python tests/oracle.py [sf_dir] [name ...]` prints one line per query.
"""

from __future__ import annotations

import math
import os
import sys
import time
from datetime import date, datetime, timezone

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def _plain(value):
    if isinstance(value, datetime):
        value = value.astimezone(timezone.utc).replace(tzinfo=None) if value.tzinfo else value
        return value.isoformat(sep=" ")
    if isinstance(value, date):
        return value.isoformat()
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(_plain(v) for v in value) + "]"
    return "NULL" if value is None else str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def connect(sf_dir: str):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def compare(spark, connection, sf_dir: str, run, sql: str | None) -> str | None:
    """None if equal, else what differs."""
    df = run(spark, sf_dir)
    got_columns, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None if got_columns else "no columns"
    cursor = connection.execute(sql)
    want_columns, want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if got != want:
        extra, lacking = sorted(set(got) - set(want))[:2], sorted(set(want) - set(got))[:2]
        return f"{len(got)} rows != {len(want)} rows; only here {extra}; only in SQL {lacking}"
    if not got:
        return "both empty"
    return None


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    os.environ.setdefault("TZ", "UTC")
    import __spark_entry__ as entry
    from tideline import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    session = build_session(
        "oracle", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
           "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    duck = connect(sf)
    failed = 0
    for name in names:
        start = time.time()
        try:
            problem = compare(session, duck, sf, entry.queries()[name], entry.oracle_sql().get(name))
        except Exception as error:  # noqa: BLE001 - report and go on
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        checked = "sql" if name in entry.oracle_sql() else "rows"
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} ({checked}, {time.time() - start:.1f}s) {problem or ''}", flush=True)
    sys.exit(1 if failed else 0)
