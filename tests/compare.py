"""Runs registered queries and their oracle SQL side by side.

    python -m tests.compare [scale folder] [name ...]
"""

from __future__ import annotations

import datetime
import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path("/root/testdata")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value.isoformat() if isinstance(value, datetime.date) else value


def as_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, connection, folder: str, name: str, build, sql: str | None) -> str | None:
    """None if equal, else what differs. Without SQL only runs the query."""
    df = build(spark, folder)
    ours = as_rows(df.columns, df.collect())
    if sql is None:
        return None if ours else "no rows"
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    theirs = as_rows(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns: ours {sorted(set(df.columns) - set(names))}, oracle {sorted(set(names) - set(df.columns))}"
    if len(ours) != len(theirs):
        return f"rows: ours {len(ours)}, oracle {len(theirs)}"
    for mine, other in zip(ours, theirs, strict=True):
        if mine != other:
            pairs = [(n, a, b) for n, a, b in zip(sorted(names), mine, other, strict=True) if a != b]
            return f"values (column, ours, oracle): {pairs[:4]}"
    return None if ours else "equal, but empty"


def main() -> int:
    import __spark_entry__ as registry
    from tallyloom import session

    arguments = sys.argv[1:]
    scale = arguments.pop(0) if arguments and arguments[0].startswith("sf") else "sf0.01"
    folder = str(ROOT / scale)
    spark = session.build(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    connection, oracle, bad = duck(folder), registry.oracle_sql(), 0
    for name, build in registry.queries().items():
        if arguments and name not in arguments:
            continue
        start = time.time()
        try:
            problem = compare(spark, connection, folder, name, build, oracle.get(name))
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:400]}"
        bad += problem is not None
        label = "ok" if problem is None else f"DIFFERS {problem}"
        print(f"{time.time() - start:6.2f}s {name}{'' if name in oracle else ' (no oracle)'}: {label}", flush=True)
    print(f"{bad} of {len(registry.queries())} differ")
    return bad


if __name__ == "__main__":
    raise SystemExit(main())
