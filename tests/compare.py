"""Run every registered query against its SQL on the same tables."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return value + 0.0
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(_plain(row[i]) for i in order) for row in rows),
        key=lambda r: tuple((v is None, str(type(v)) if v is None else "", str(v)) for v in r),
    )


def compare(spark, connection, sf_dir, name, query, sql) -> str:
    result = query(spark, sf_dir)
    ours = [tuple(r) for r in result.collect()]
    cursor = connection.execute(sql)
    columns = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    if sorted(result.columns) != sorted(columns):
        return f"columns differ: {set(result.columns) ^ set(columns)}"
    if len(ours) != len(theirs):
        return f"rows differ: {len(ours)} vs {len(theirs)}"
    a, b = rows_of(result.columns, ours), rows_of(columns, theirs)
    bad = [(x, y) for x, y in zip(a, b, strict=True) if x != y]
    if bad:
        return f"{len(bad)} of {len(a)} rows differ, e.g.\n  {str(bad[0][0])[:600]}\n  {str(bad[0][1])[:600]}"
    return f"ok {len(ours)} rows"


def main() -> None:
    import __spark_entry__ as entry
    from wardframe.session import get_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    only = sys.argv[2].split(",") if len(sys.argv) > 2 else None
    spark = get_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("OFF")
    connection = oracle_connection(sf_dir)
    sqls = entry.oracle_sql()
    failed = []
    for name, query in entry.queries().items():
        if only and not any(name.startswith(o) for o in only):
            continue
        begun = time.time()
        try:
            if name in sqls:
                verdict = compare(spark, connection, sf_dir, name, query, sqls[name])
            else:
                verdict = f"ok (rows only) {query(spark, sf_dir).count()}"
        except Exception as error:  # noqa: BLE001
            verdict = f"ERROR {type(error).__name__}: {str(error)[:1500]}"
        if not verdict.startswith("ok"):
            failed.append(name)
        print(f"{name:36s} {time.time() - begun:6.2f}s {verdict}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()
