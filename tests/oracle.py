"""Run registered queries and their SQL side by side and compare rows, names and types."""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, decimal.Decimal):
        return f"{float(value):.9g}"
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
         "timestamp_ntz": "TIMESTAMP", "date": "DATE"}


def compare(spark, con, sf_dir, name, run, sql) -> tuple[str, float]:
    """('' when equal, else what differs; seconds of the Spark side)."""
    start = time.time()
    df = run(spark, sf_dir)
    got = df.collect()
    took = time.time() - start
    kinds = {c: KINDS.get(t, t) for c, t in df.dtypes}
    result = con.sql(sql)
    expected_kinds = dict(zip(result.columns, map(str, result.types)))
    if kinds != expected_kinds:
        return f"columns {kinds} != {expected_kinds}", took
    want = _rows(result.columns, result.fetchall())
    have = _rows(df.columns, got)
    if have != want:
        sample = [r for r in have if r not in set(want)][:2], [r for r in want if r not in set(have)][:2]
        return f"rows {len(have)} != {len(want)} {sample}", took
    return "", took


if __name__ == "__main__":
    import __spark_entry__ as entry
    from silvermill.session import get_spark

    sf = sys.argv[1]
    only = sys.argv[2:]
    spark = get_spark("oracle", **{"spark.master": "local[8]", "spark.sql.shuffle.partitions": "8",
                                   "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    bad = 0
    for name, run in entry.queries().items():
        if only and name not in only:
            continue
        try:
            if name not in entry.oracle_sql():
                print(f"{name}: no SQL, {run(spark, sf).count()} rows")
                continue
            problem, took = compare(spark, con, sf, name, run, entry.oracle_sql()[name])
        except Exception as error:  # noqa: BLE001
            problem, took = f"{type(error).__name__}: {str(error)[:1500]}", 0
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {took:.2f}s {problem}", flush=True)
    print("failed:", bad)
