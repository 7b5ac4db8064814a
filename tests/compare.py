"""Run registered queries and their SQL on the same tables and compare all values.

    python tests/compare.py [folder of tables] [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def expected(sf_dir: str, sql: str) -> tuple[list[str], Counter]:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from read_parquet('{sf_dir}/{table}.parquet')")
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    return sorted(names), normal(names, result.fetchall())


def normal(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=names.__getitem__)
    return Counter(tuple(repr(row[i]) for i in order) for row in rows)


def difference(spark: SparkSession, sf_dir: str, query, sql: str) -> str | None:
    frame = query(spark, sf_dir)
    found = normal(frame.columns, map(tuple, frame.collect()))
    names, wanted = expected(sf_dir, sql)
    if sorted(frame.columns) != names:
        return f"columns {sorted(frame.columns)}, expected {names}"
    if found != wanted:
        extra, absent = list((found - wanted).items())[:2], list((wanted - found).items())[:2]
        return f"{found.total()} rows, expected {wanted.total()}; extra {extra}, absent {absent}"
    return None


def main() -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    import __spark_entry__ as contract

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    sqls, failures = contract.oracle_sql(), 0
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name, query in contract.queries().items():
        if name not in sqls or sys.argv[2:] and name not in sys.argv[2:]:
            continue
        began = time.time()
        try:
            problem = difference(spark, sf_dir, query, sqls[name])
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failures += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - began:.1f}s {problem or ''}", flush=True)
    return failures


if __name__ == "__main__":
    sys.exit(main())
