"""Row-for-row comparison of the Spark queries with their SQL on DuckDB.

Run as a script: ``python tests/compare.py [sf_dir] [query ...]``.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value.normalize()))
    if isinstance(value, bool):
        return ("bool", value)
    if isinstance(value, float):
        return ("nan",) if math.isnan(value) else ("float", value)
    if isinstance(value, dt.datetime):
        return ("timestamp", value.replace(tzinfo=None))
    return (type(value).__name__, value)


def rows(columns, data) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in data)


def difference(con, sql: str, df) -> str | None:
    """What differs between a DataFrame and its SQL, or None."""
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    want = rows(names, found.fetchall())
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    if want == got:
        return None
    return (
        f"{sum(got.values())} rows against {sum(want.values())}; only in Spark "
        f"{list((got - want).items())[:2]}; only in SQL {list((want - got).items())[:2]}"
    )


def main() -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(sf_dir), entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            problem = difference(con, sqls[name], fn(spark, sf_dir)) if name in sqls else "no SQL"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'BAD '} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
