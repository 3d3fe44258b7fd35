"""Run registered queries and their SQL counterparts side by side.

    python tests/compare.py [folder] [name ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    return value


def multiset(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark: SparkSession, con, query, sql: str, folder: str) -> str:
    """Empty when both give the same columns and rows, else the first difference."""
    df = query(spark, folder)
    names, mine = multiset(df.columns, df.collect())
    result = con.execute(sql)
    theirs_names = [d[0] for d in result.description]
    theirs_names, theirs = multiset(theirs_names, result.fetchall())
    if names != theirs_names:
        return f"columns {names} != {theirs_names}"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} != {len(theirs)}"
    for a, b in zip(mine, theirs):
        if a != b:
            return "values " + str([(n, x, y) for n, x, y in zip(names, a, b) if x != y][:4])
    return ""


def session() -> SparkSession:
    spark = (SparkSession.builder.master("local[8]").appName("compare")
             .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    import __spark_entry__ as entry

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    queries, oracle = entry.queries(), entry.oracle_sql()
    spark, con = session(), duck(folder)
    bad = 0
    for name in sys.argv[2:] or queries:
        start = time.time()
        try:
            problem = compare(spark, con, queries[name], oracle[name], folder)
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {problem}", flush=True)
    print(f"{bad} failing")


if __name__ == "__main__":
    main()
