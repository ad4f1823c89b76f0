"""Run registered queries beside their SQL in DuckDB and compare all rows.

usage: python tools/check_oracle.py [folder] [name ...]
"""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def plain(value):
    """Comparable form: integers and whole floats alike, everything else as is."""
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, int):
        return float(value)
    try:
        number = float(value)
    except (TypeError, ValueError):
        return str(value)
    return "NaN" if number != number else number + 0.0


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def duck(folder):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def compare(spark, con, folder, run, sql):
    """(problem or None, rows, seconds)"""
    start = time.time()
    df = run(spark, folder)
    rows = [tuple(r) for r in df.collect()]
    took = time.time() - start
    if sql is None:
        return (None if rows else "no rows"), len(rows), took
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}", len(rows), took
    mine, other = bag(df.columns, rows), bag(names, expected)
    if mine == other:
        return None, len(rows), took
    only_mine, only_other = list((mine - other).items())[:3], list((other - mine).items())[:3]
    text = f"{len(rows)} vs {len(expected)} rows; {sorted(names)} mine {only_mine} sql {only_other}"
    return text, len(rows), took


def main(argv):
    from delaykit.catalogue import REGISTRY
    from delaykit.session import build_session

    folder = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    wanted = argv[2:] or list(REGISTRY)
    conf = {"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.enabled": "false"}
    if os.environ.get("PLAIN_SESSION"):  # a session that knows nothing of this library
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.master("local[8]").config(
            "spark.sql.shuffle.partitions", "8"
        ).getOrCreate()
    else:
        spark = build_session("check", "local[8]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    bad = 0
    for name in wanted:
        entry = REGISTRY[name]
        try:
            problem, n, took = compare(spark, con, folder, entry.run, entry.sql)
        except Exception as error:  # noqa: BLE001 - shown to the reader
            problem, n, took = f"{type(error).__name__}: {str(error)[:1500]}", 0, 0.0
        bad += problem is not None
        kind = "sql " if entry.sql else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {kind} {name} {n} rows {took:.2f}s {problem or ''}", flush=True)
    print(f"{len(wanted) - bad} of {len(wanted)} good")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
