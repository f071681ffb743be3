"""Run registered queries against their SQL counterparts: python tests/compare.py [sf_dir] [names]."""

from __future__ import annotations

import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return db


def plain(value):
    if isinstance(value, float):
        return round(value, 6) + 0.0
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted(
        (tuple(plain(r[i]) for i in order) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r)
    )


def compare(df, db, sql: str) -> str | None:
    """None when equal, else what differs."""
    spark_rows = rows_of(df.columns, df.collect())
    cursor = db.execute(sql)
    names = [d[0] for d in cursor.description]
    duck_rows = rows_of(names, cursor.fetchall())
    if spark_rows[0] != duck_rows[0]:
        return f"columns {spark_rows[0]} != {duck_rows[0]}"
    if spark_rows[1] != duck_rows[1]:
        a, b = spark_rows[1], duck_rows[1]
        diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
        return f"{len(a)} rows != {len(b)} rows; {diff}"
    return None


def session(app: str = "lexigrid"):
    return (
        SparkSession.builder.master("local[8]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def main() -> int:
    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(sf_dir)
    sql, bad = entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            result = compare(df, db, sql[name]) if name in sql else f"rows only: {df.count()}"
        except Exception as e:  # report and go on with the next query
            result = f"{type(e).__name__}: {str(e)[:600]}"
        ok = result is None or result.startswith("rows only")
        bad += not ok
        print(f"{'ok ' if ok else 'BAD'} {name} {time.time() - start:.2f}s {result or ''}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
