"""Compare every query with its SQL: ``python -m checks.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

from checks import oracles, queries

TABLES = ("region nation customer supplier part orders lineitem events").split()


def connect(sf_dir: str):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')"
        )
    return connection


def difference(spark: SparkSession, connection, sf_dir: str, name: str) -> str | None:
    """What differs between a query and its SQL; None if they agree."""
    frame = queries.all_queries()[name](spark, sf_dir)
    columns = sorted(frame.columns)
    got = Counter(tuple(row[c] for c in columns) for row in frame.collect())
    relation = connection.sql(oracles.all_queries()[name])
    if sorted(relation.columns) != columns:
        return f"columns {columns} <> {sorted(relation.columns)}"
    order = [relation.columns.index(c) for c in columns]
    want = Counter(tuple(row[i] for i in order) for row in relation.fetchall())
    kinds = {
        c: (frame.schema[c].dataType.simpleString(), str(relation.types[relation.columns.index(c)]))
        for c in columns
    }
    same = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN"}
    odd = {c: k for c, k in kinds.items() if same.get(k[0], k[0].upper()) != k[1]}
    if odd:
        return f"types {odd}"
    if got != want:
        return f"rows {sum(got.values())} <> {sum(want.values())}: only Spark " + str(
            list((got - want).items())[:3]
        ) + " only SQL " + str(list((want - got).items())[:3])
    return None if got else "no rows"


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(queries.all_queries())
    spark = (
        SparkSession.builder.master(f"local[{os.environ.get('BENCH_CPUS', '8')}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    missing = set(queries.all_queries()) ^ set(oracles.all_queries())
    print("without counterpart:", sorted(missing))
    bad = 0
    for name in names:
        start = time.perf_counter()
        try:
            problem = difference(spark, connection, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{name}: {problem or 'ok'} ({time.perf_counter() - start:.1f} s)", flush=True)
    print(f"{len(names)} queries, {bad} differ")
    sys.exit(bad > 0)


if __name__ == "__main__":
    main()
