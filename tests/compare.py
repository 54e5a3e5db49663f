"""Run catalogue queries on Spark and their SQL on DuckDB and compare the rows."""

from __future__ import annotations

import math
import sys
import time
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(folder: str):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, bool):
        return ("b", value)
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return ("null",) if math.isnan(value) else ("n", float(f"{value:.9g}"))
    if isinstance(value, int):
        return ("n", float(value))
    if isinstance(value, datetime):
        return ("t", value.replace(tzinfo=None).isoformat())
    if isinstance(value, date):
        return ("d", value.isoformat())
    if value is None:
        return ("null",)
    return ("s", str(value))


def _sorted(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def differences(spark_frame, connection, sql: str) -> str | None:
    names = spark_frame.columns
    mine = _sorted([tuple(r) for r in spark_frame.collect()], names)
    cursor = connection.execute(sql)
    their_names = [d[0] for d in cursor.description]
    theirs = _sorted(cursor.fetchall(), their_names)
    if sorted(names) != sorted(their_names):
        return f"columns {sorted(names)} / {sorted(their_names)}"
    if len(mine) != len(theirs):
        a, b = set(mine), set(theirs)
        return f"rows {len(mine)} / {len(theirs)}; only here {list(a - b)[:2]}; only there {list(b - a)[:2]}"
    for left, right in zip(mine, theirs):
        if left != right:
            a, b = set(mine), set(theirs)
            return f"{sorted(names)}: {len(a - b)} differ; only here {sorted(a - b, key=repr)[:3]}; only there {sorted(b - a, key=repr)[:3]}"
    return None if mine else "EMPTY (equal)"


def main(folder: str, wanted: list[str]) -> int:
    from loadstone.catalog import all_queries, all_sql
    from loadstone.session import get_session

    spark = get_session("compare", 8)
    spark.sparkContext.setLogLevel("ERROR")
    connection, sql, bad = duck(folder), all_sql(), 0
    for name, run in all_queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.monotonic()
        try:
            if name in sql:
                problem = differences(run(spark, folder), connection, sql[name])
            else:
                problem = f"no SQL, {run(spark, folder).count()} rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{time.monotonic() - start:6.2f}s {name}: {problem or 'ok'}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
