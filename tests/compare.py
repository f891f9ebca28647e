"""Run catalog queries next to their SQL and compare whole results.

    python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def tidy(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    if hasattr(value, "tzinfo") and value is not None:
        return value.replace(tzinfo=None).isoformat()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(tidy(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name, sf_dir):
    """None when equal, else a short description of the difference."""
    from catalog.queries import CATALOG

    item = CATALOG[name]
    frame = item.spark(spark, sf_dir)
    got = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    if item.sql is None:
        return None if got else "no rows"
    cursor = con.execute(item.sql)
    columns = [d[0] for d in cursor.description]
    want = rows_of(columns, cursor.fetchall())
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(columns)}"
    if got == want:
        return None
    missing, extra = list(set(want) - set(got))[:3], list(set(got) - set(want))[:3]
    return f"{len(got)} rows, expected {len(want)}; {sorted(columns)} missing {missing} extra {extra}"


def main():
    from pyspark.sql import SparkSession

    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    from catalog.queries import CATALOG

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(sf_dir), 0
    for name in args[1:] or CATALOG:
        start = time.time()
        try:
            problem = compare(spark, con, name, sf_dir)
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{bad} problems")
    spark.stop()


if __name__ == "__main__":
    main()
