"""Runs every query next to its SQL in DuckDB: python tests/check_oracles.py [sf_dir] [name ...]"""

from __future__ import annotations

import sys
import time
from collections import Counter
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def normal(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, float, Decimal)):
        return Decimal(str(value)).normalize()
    if isinstance(value, (date, datetime)):
        return value.isoformat()
    return value


def as_bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(normal(r[i]) for i in order) for r in rows)


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def compare(spark, con, name, query, sql, sf_dir):
    """Returns (matches, rows, message)."""
    frame = query(spark, sf_dir)
    got = as_bag(frame.columns, frame.collect())
    result = con.execute(sql)
    want = as_bag([d[0] for d in result.description], result.fetchall())
    if got == want:
        return True, sum(got[1].values()), ""
    message = f"columns {got[0]} / {want[0]}" if got[0] != want[0] else (
        f"only Spark: {list((got[1] - want[1]).items())[:3]}\n only SQL: {list((want[1] - got[1]).items())[:3]}"
    )
    return False, sum(got[1].values()), message


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from ledgerproof.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sqls = oracle_sql()
    bad = 0
    for name, query in queries().items():
        if only and name not in only:
            continue
        began = time.time()
        try:
            ok, rows, message = compare(spark, con, name, query, sqls[name], sf_dir)
        except Exception as error:  # one broken query must not hide the others
            ok, rows, message = False, -1, f"{type(error).__name__}: {str(error)[:600]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:34s} rows={rows:<7d} {time.time() - began:6.2f}s {message}")
    print("failures:", bad)
    sys.exit(bool(bad))
